"""Secret scans and quality rules."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cadence.llm import quality_rules, queries, secrets_scan
from tests.conftest import SF_SMALL
from tests.llm.tables import awkward, by_id, clashing, documents, row

KINDS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]
SECRETS = [
    row(50, "password=token: abcdefgh secret:'abc' API_KEY = \"a.b-c/d=e\" token==x"), row(51, "é日 AKIAAKIA" + "Q" * 20 + "AKIA" + "b" * 30),
    row(52, "passwd=" + "0" * 40 + " " + "a" * 24 + "g" + "f" * 23), row(53, "SECRET: " + "é" * 9 + " apikey:      'xyzxyz'"),
]


def scanned(text):
    spans = sorted((m.start(), i, m.end(), name) for i, (name, p, ok) in enumerate(KINDS) for m in p.finditer(text or "") if ok(m))
    return ",".join(f"{name}:{a}:{b}" for a, _, b, name in spans)


def test_spans_against_plain_scan(spark, tmp_root):
    rows = awkward() + SECRETS
    docs = clashing(documents(spark, rows), ["blob", "assign", "hex"])
    got = secrets_scan.findings(docs, f"{tmp_root}/ledger", carry=("doc_id", "source", "assign")).withColumn("spans", secrets_scan.listing())
    assert by_id(got.collect(), "spans") == sorted((str(r[0]), scanned(r[1])) for r in rows)


def test_op4_digests(spark):
    for r in queries.op4_blob_ledger_secrets(spark, SF_SMALL).collect():
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == (r.spans.count(",") + 1 if r.spans else 0)


def test_ledger_scans_only_unseen_pairs(spark, tmp_root):
    path, rows = f"{tmp_root}/ledger", awkward() + SECRETS
    blobs = len({r[1] or "" for r in rows[:10]})
    secrets_scan.scan(documents(spark, rows[:10]), path)
    assert spark.read.parquet(path).count() == 3 * blobs
    secrets_scan.scan(documents(spark, rows), path)
    every = len({r[1] or "" for r in rows})
    assert spark.read.parquet(path).count() == 3 * every
    newer = tuple(r if r.name != "hex" else secrets_scan.Rule("hex", 2, r.pattern, r.group, 40) for r in secrets_scan.RULES)
    got = secrets_scan.scan(documents(spark, rows), path, rules=newer)
    assert spark.read.parquet(path).count() == 4 * every and got.count() == every
    hexes = got.filter(F.size("hex") > 0).collect()
    assert len(hexes) == 1 and hexes[0].hex[0].end - hexes[0].hex[0].start == 40


def test_time_in_proportion_to_the_matches_of_a_text(spark, tmp_root):
    """Four times the matches in one text take about four times as long, and all places are right."""
    import time

    def timed(n):
        text = "é token=abcdef12 " * n
        docs = documents(spark, [row(1, text)])
        start = time.monotonic()
        (found,) = secrets_scan.findings(docs, f"{tmp_root}/ledger-{n}").collect()
        took = time.monotonic() - start
        assert [(s.start, s.end) for s in found.assign] == [(17 * i + 2, 17 * i + 16) for i in range(n)]
        return took

    timed(100)
    assert timed(64_000) <= 4.5 * timed(16_000)
    text = "é token=abcdef12 " * 8000
    (clean,) = secrets_scan.redact(documents(spark, [row(1, text)]), f"{tmp_root}/redact").collect()
    assert clean.text == "é [SECRET] " * 8000


def test_plan_is_native(spark, tmp_root):
    plan = secrets_scan.findings(documents(spark), f"{tmp_root}/l")
    assert not re.search("Python|Arrow|Pandas", plan.drop("doc_id")._jdf.queryExecution().optimizedPlan().toString())


def test_redaction_replaces_overlaps_together(spark, tmp_root):
    docs = clashing(documents(spark, awkward() + SECRETS), ["_blob", "_spans"])
    out = secrets_scan.redact(docs, f"{tmp_root}/ledger")
    assert out.columns == docs.columns
    want = []
    for r in awkward() + SECRETS:
        text, at, left = r[1], 0, []
        for s in filter(None, sorted(scanned(text).split(","), key=lambda s: [int(x) for x in s.split(":")[1:]] if s else [])):
            a, b = (int(x) for x in s.split(":")[1:])
            if a >= at:
                left += [text[at:a], "[SECRET]"]
            at = max(at, b)
        want.append((str(r[0]), str(None if text is None else "".join(left) + text[at:])))
    assert by_id(out.collect(), "text") == sorted(want)


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    count, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_of_awkward_rows(spark):
    rows = awkward() + [row(60, "a b c a b c a b c x " * 20), row(61, "\x1cone\x85two\x0bthree\x0c"), row(62, "|\n|\n | \n\n#*$%&<> a")]
    docs = clashing(documents(spark, rows), ["kept", "n_words", "vote_length"])
    got = quality_rules.judge(docs, carry=("doc_id", "source", "kept"))
    assert by_id(got.collect(), *COLUMNS) == sorted((str(r[0]), *map(str, measured(r[1]))) for r in rows)
    assert not got.filter("base_failed AND kept").count()
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_op5_measures_and_labels(spark):
    rows = queries.op5_weak_supervision(spark, "/root/testdata/sf0.01")
    texts = queries.table(spark, "/root/testdata/sf0.01", "documents").collect()
    assert by_id(rows.collect(), *COLUMNS) == sorted((str(r.doc_id), *map(str, measured(r.text))) for r in texts)
    held = rows.join(queries.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("NOT base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) >= 0.98
    assert np.mean([r.kept for r in held if r.quality == 1]) >= 0.99


def test_fit_recovers_planted_accuracies():
    """Good documents are voted good, junk is caught by some rules each; the fit tells rules that err from those that don't."""
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.85
    votes = np.where(good[:, None], np.where(rng.random((20_000, 4)) < [0.01, 0.01, 0.02, 0.3], -1, 1), np.where(rng.random((20_000, 4)) < [0.8, 0.7, 0.6, 0.3], -1, 1))
    patterns, at = np.unique(votes, axis=0, return_inverse=True)
    odds, ratios = quality_rules.fit(patterns, np.zeros(len(patterns), bool), np.bincount(at).astype(float))
    score = odds + ((votes == -1) * ratios[:, 0] + (votes == 1) * ratios[:, 1]).sum(1)
    assert ((score > 0) == good).mean() > 0.95
    assert ratios[3, 0] > ratios[0, 0]
