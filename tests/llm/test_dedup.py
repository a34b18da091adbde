"""Near duplicates, repeated passages and boilerplate lines against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import chunks, lines, minhash, queries, substring
from cadence.llm.shingles import shingles
from tests.conftest import SF_SMALL
from tests.llm.tables import SCHEMA, awkward, by_id, clashing, documents, prose, row


def sets(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_classes(rows, threshold=0.8):
    """Class of each row by all pairs: equal texts, or similar sets; null texts alone."""
    rows = [(i, t) for i, t in rows if t is not None]
    own, top = [sets(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    holders = {}
    for i, s in enumerate(own):
        near = Counter(j for g in s for j in holders.get(g, ()))
        for j, both in near.items():
            if both >= threshold * (len(s) + len(own[j]) - both) - 1e-9:
                top[find(i)] = find(j)
        for g in s:
            holders.setdefault(g, []).append(i)
    first = {}
    for i, (_, t) in enumerate(rows):
        top[find(i)] = find(first.setdefault(t, i))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return sorted((str(d), str(min((x for x in ids[find(i)] if x is not None), default=None))) for i, (d, _) in enumerate(rows))


def edited(text, n, seed):
    rnd, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def test_op3_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF_SMALL, "documents").collect()]
    assert by_id(queries.op3_prob_minhash(spark, SF_SMALL).collect(), "class_id") == brute_classes(docs)


def test_near_copies_large_group_chains_and_awkward_rows(spark):
    """Copies of copies form chains in which the ends are not similar; one group is large."""
    base, chain = prose(300, 50), [prose(120, 51)]
    for k in range(8):
        chain.append(edited(chain[-1], 2, k))
    rows = awkward() + [row(100 + k, edited(base, k % 9, k)) for k in range(150)] + [row(400 + k, t) for k, t in enumerate(chain)] + [row(500 + k, base) for k in range(60)]
    docs = clashing(documents(spark, rows), ["class_id", "_node", "_class"])
    got = [r for r in minhash.near_duplicates(docs).collect()]
    alone = [r for r in got if r.class_id is None or (r.doc_id == 1 and r.class_size == 1)]
    assert len(got) == len(rows) and len(alone) >= 2
    want = brute_classes([(r[0], r[1]) for r in rows])
    nulls = sorted((str(r[0]), str(r[0])) for r in rows if r[1] is None)
    assert by_id(got, "class_id") == sorted(want + nulls)


def test_near_copies_with_passages_repeated_often(spark):
    """How often a passage stands in a text does not part copies: sets of shingles decide."""
    rows = []
    for k in range(40):
        words, line = prose(200, 6000 + k).split(), prose(10, 6500 + k).split()
        rows += [row(4 * k, " ".join(words)), row(4 * k + 1, " ".join(words + words[-60:] * 50))]
        rows += [row(4 * k + 2, " ".join(words[:100] + line)), row(4 * k + 3, " ".join(words[:100] + line * 100))]
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert by_id(got, "class_id") == brute_classes([(r[0], r[1]) for r in rows])


def test_weights_change_the_bands_of_texts_with_repeats():
    plain, often = prose(80, 7000), prose(80, 7000) + (" " + prose(9, 7001)) * 30
    data = np.frombuffer((plain + often).encode(), np.uint8)
    owner, shingle, count = shingles(data, np.array([0, len(plain.encode()), len(data)]))
    have, keys = minhash.text_bands(owner, shingle, count)
    unit = minhash.band_keys(minhash.sketch(owner, shingle, np.ones(len(owner)), 2, minhash.REGISTERS))
    assert have.tolist() == [0, 1] and keys[0].tolist() == unit[0].tolist()
    assert set(unit[1]) < set(keys[1]) and len(keys[1]) > 1.3 * minhash.BANDS


def test_common_elements_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    a, b = ([np.unique(rng.integers(0, 90, n)).astype("<u4") for n in (1, 5, 40, 200, 17)] for _ in range(2))
    want = lambda x, y: [[len(set(p) & set(q)) for q in y] for p in x]
    off = ~np.eye(5, dtype=bool)
    assert minhash.common(a, b).tolist() == want(a, b) and (minhash.common(a)[off] == np.array(want(a, a))[off]).all()


def test_edited_copies_without_the_original(spark, monkeypatch):
    """Pairs near the threshold: all-pairs classes, in blocks too, and rows in proportion to the copies."""
    base = prose(150, 8000)
    made = {n: [row(k, edited(base, 3, 9000 + k)) for k in range(n)] for n in (200, 800)}
    rows, counted = {}, minhash.materialise

    def noted(df, label):
        out = counted(df, label)
        rows[n][label] = rows[n].get(label, 0) + out.count()
        return out

    for n in made:
        rows[n] = {}
        with monkeypatch.context() as m:
            m.setattr(minhash, "materialise", noted)
            got = minhash.near_duplicates(documents(spark, made[n])).collect()
        assert by_id(got, "class_id") == brute_classes([(r[0], r[1]) for r in made[n]])
    # Links are rows of classes, at most one for each member of a bucket, and classes one for each node and round;
    # of 200 copies so few are similar that their numbers say nothing.
    over = {k: (rows[200].get(k), n) for k, n in rows[800].items() if n > 4.6 * rows[200].get(k, 0) + 50 and k not in ("near-links", "near-classes")}
    assert not over, str(over)
    assert rows[800]["near-links"] < rows[800]["near-buckets"] / 4 and rows[800]["near-classes"] < 12 * 800
    monkeypatch.setattr(minhash, "BLOCK_NODES", 64)
    got = minhash.near_duplicates(documents(spark, made[200])).collect()
    assert by_id(got, "class_id") == brute_classes([(r[0], r[1]) for r in made[200]])


def test_keep_one_keeps_whole_rows(spark):
    rows = awkward() + [row(100 + k, prose(200, 3)) for k in range(5)]
    docs = clashing(documents(spark, rows), ["_node", "_check"])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    classes = dict(brute_classes([(r[0], r[1]) for r in rows if r[0] is not None]))
    want = {(str(r[0]), str(r[1])) for r in rows if r[0] is not None and r[1] is not None and classes[str(r[0])] == str(r[0])}
    assert [x for x in got if x[1] != "None" and x[0] != "None"] == sorted(want)
    assert sum(x[1] == "None" for x in got) == 2
    assert minhash.keep_one(documents(spark, [])).count() == 0


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(1, 1 << 44, 400, dtype=np.uint64)
    for shared in (100, 250, 350):
        b = np.concatenate([a[:shared], rng.integers(1, 1 << 44, 400 - shared, dtype=np.uint64)])
        weight = np.concatenate([np.repeat([1.0, 2.0], 200), np.repeat([1.0, 2.0], 200)])
        registers = 4000
        out = minhash.sketch(np.repeat([0, 1], 400), np.concatenate([a, b]), weight, 2, registers)
        p, q = dict(zip(a.tolist(), weight[:400])), dict(zip(b.tolist(), weight[400:]))
        exact = sum(1 / sum(max(p.get(j, 0) / p[i], q.get(j, 0) / q[i]) for j in {*p, *q}) for i in p.keys() & q.keys())
        assert abs((out[0] == out[1]).mean() - exact) < 0.035


def test_shingles_of_blocks_equal_those_of_whole_texts(monkeypatch):
    from cadence.llm import shingles as module, tokens

    texts = [t or "" for _, t, *_ in awkward()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    whole = shingles(data, ends)
    assert np.bincount(whole[0], minlength=len(texts)).tolist() == [len(sets(t)) for t in texts]
    monkeypatch.setattr(module, "BLOCK", 1 << 20)
    assert all((x == y).all() for x, y in zip(whole, shingles(data, ends), strict=True))
    assert tokens.BLOCK > module.BLOCK


def test_chunk_ends_cover_texts_and_resist_insertions():
    text = prose(3000, 60)
    data = np.frombuffer(("inserted here " + text + text).encode(), np.uint8)
    n = len(text.encode())
    ends = np.array([0, 14 + n, 14 + 2 * n])
    cut, upto = chunks.chunk_ends(data, ends, 5, 12, 256)
    assert cut[-1] == len(data) and upto[-1] == len(cut) and sorted(set(cut)) == cut and 14 + n in cut
    raw = data.tobytes()
    pieces = [raw[a:b] for a, b in zip([0, *cut[:-1]], cut)]
    assert all(p.decode() for p in pieces)
    first, second = set(pieces[: upto[1]]), set(pieces[upto[1] :])
    assert len(first & second) >= 0.98 * len(second)


def test_passages_are_taken_out_but_the_first(spark):
    docs = clashing(documents(spark), ["removed", "repeats_of", "_row", "_doc"])
    got = {r.doc_id: r for r in substring.drop_repeated_passages(docs, carry=("doc_id", "source", "_row")).collect() if r.doc_id not in (None, 6)}
    texts = {r[0]: r[1] for r in awkward()}
    for doc_id, r in got.items():
        if doc_id in (7, 10):
            assert r.repeats_of == [{7: 6, 10: 9}[doc_id]]
            left, at = [], 0
            for span in r.removed:
                left.append(texts[doc_id][at : span.start])
                at = span.end
            assert r.text == "".join(left) + texts[doc_id][at:]
            assert len(r.text) < len(texts[doc_id]) - 200
        else:
            assert r.text == texts[doc_id] and not r.removed
    assert len([r for r in got.values()]) == len({d for d in texts if d not in (None, 6)})


def test_op6_finds_every_passage_of_51_words(spark):
    docs = queries.table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()
    first, repeats, loose = {}, set(), set()
    for n, found in ((51, repeats), (20, loose)):
        first.clear()
        for r in docs:
            words = r.text.split()
            for k in range(len(words) - n + 1):
                if first.setdefault(tuple(words[k : k + n]), r.doc_id) != r.doc_id:
                    found.add(r.doc_id)
    flagged = {r.doc_id for r in queries.op6_chunk_passages(spark, SF_SMALL).collect() if r.n_removed}
    assert repeats <= flagged <= loose


def test_op6_takes_out_every_word_of_planted_passages(spark):
    """Passages of 20 to 60 words, in every language, between other texts: as by brute force, up to their edges."""
    by_lang = {}
    for r in queries.table(spark, SF_SMALL, "documents").orderBy("doc_id").collect():
        if len(set(r.text.split())) > 40 and len(r.text.split()) >= 60:
            by_lang.setdefault(r.lang, []).append(r.text.split())
    assert len(by_lang) >= 4
    rows, planted = [], 0
    for lang, texts in sorted(by_lang.items()):
        for k in range(60):
            words, n = texts[k % len(texts)], (20, 21, 30, 51, 60)[k % 5]
            at, planted = random.Random(f"{lang} {k}").randrange(len(words) - n + 1), planted + 1
            for d, gap in ((0, "\n "), (1000, " ")):
                rows.append((d + planted, gap.join([prose(35, 9000 + d + planted), *words[at : at + n], prose(25, 7000 + d + planted)])))
    first, want = {}, {}
    for d, t in sorted(rows):
        words = t.split()
        grams = [tuple(words[k : k + 20]) for k in range(len(words) - 19)]
        again = [k for k, g in enumerate(grams) if first.setdefault(g, d) != d]
        gone = {w for k in again for w in range(k, k + 20)}
        want[d] = [w for k, w in enumerate(words) if k not in gone], sorted({first[grams[k]] for k in again})
    assert all(want[1000 + k][1] for k in range(1, planted + 1))
    got = {r.doc_id: r for r in substring.drop_repeated_passages(documents(spark, [row(*r) for r in rows])).collect()}
    assert {d: r.text.split() for d, r in got.items()} == {d: left for d, (left, _) in want.items()}
    assert all(set(r.repeats_of) <= set(want[d][1]) and bool(r.repeats_of) == bool(want[d][1]) for d, r in got.items())


def test_lines_over_the_ratio_go(spark):
    flat = lambda seed: "\n".join(" ".join(prose(12, 50 * seed + j).split()) for j in range(3))  # noqa: E731  lines of one page each
    rows = [row(k, f"Menu\n\n{flat(k)}\n  Menu \nfooter {k % 3}", "hot" if k % 3 else "other") for k in range(60)]
    rows += [row(90, "Menu", "hot"), row(91, None, "hot"), row(92, "", "hot"), row(93, "Menu\nown line", None)] + [row(94, "copy\nof a page", "copies")] * 30
    docs = clashing(documents(spark, rows), ["_site", "_boilerplate"])
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(docs, F.col("source")).collect()}
    assert got[90] == "Menu" and got[91] is None and got[92] == "" and got[93] == "Menu\nown line" and got[94] == "copy\nof a page"
    for k in range(60):
        assert got[k] == "\n" + flat(k)
    assert lines.drop_boilerplate(documents(spark, []), F.col("source")).count() == 0
    plan = lines.drop_boilerplate(docs, F.col("source"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_keeps_the_text_of_edited_copies(spark):
    """A third of a source's texts are copies with one changed line each: their text survives, boilerplate goes."""
    from cadence.llm import stages

    flat = lambda words, seed: " ".join(prose(words, seed).split())
    body = [flat(20, 3000 + k) for k in range(10)]
    rows = [row(k, "\n".join(["Menu of the site", *(flat(12, 4000 + 9 * k + j) for j in range(8))])) for k in range(40)]
    for k in range(20):
        own = list(body)
        own[k % 10] = flat(20, 5000 + k)
        rows.append(row(100 + k, "\n".join(["Menu of the site", *own])))
    found = stages.near_dedup(spark, stages.line_dedup(spark, documents(spark, rows), SF_SMALL), SF_SMALL).collect()
    assert len(found) >= 41 and all(r.n_chars == len(r.text) for r in found)
    held = Counter(line for r in found for line in r.text.split("\n"))
    assert "Menu of the site" not in held and all(held[line] for line in body)
    texts = {r.doc_id: r.text for r in found}
    assert all(texts[d] == t.split("\n", 1)[1] for d, t, *_ in rows if d in texts)


def test_sites_of_long_shared_lines_and_of_few_pages(spark):
    """Three shared lines longer than the body go from all pages, and from a host of four."""
    flat = lambda words, seed: " ".join(prose(words, seed).split())
    shared = [flat(25, 3500 + k) for k in range(3)]
    rows = [row(k, "\n".join([*shared, flat(30, 3600 + k)]), "large") for k in range(200)]
    rows += [row(500 + k, "\n".join([*shared, flat(30, 3900 + k)]), "small") for k in range(4)]
    got = lines.drop_boilerplate(documents(spark, rows), F.col("source"), dropped="gone").collect()
    assert sum(r.gone for r in got if r.source == "large") == 600 and sum(r.gone for r in got if r.source == "small") == 12


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("<p>a<b>b</b></p><div class='x'> c  d </div>", "\nab\nc d\n"),
    ("<script>var t='</p>';</script>x<!-- <p> -->y<br/>z", " x y\nz"),
])
def test_page_lines(spark, html, want):
    one = spark.createDataFrame([(html,)], "html string")
    assert one.select(lines.page_lines(F.col("html")).alias("t")).first().t == want


def test_page_lines_equal_the_plain_patterns(spark):
    """White space that stays as it is need not be matched; the text is that of the patterns which match all of it."""
    rnd = random.Random(8)
    pieces = [" ", "  ", "\n", "\t", "\r", "\f", " \n ", "a", "é b", "<p>", "</DIV >", "<br/>", "<b>", "<", "<script>x <p> y</script>", "<STYLE a>\n</style>", "<!-- <li>\n -->", "<!--"]
    pages = ["".join(rnd.choices(pieces, k=rnd.randint(1, 14))) for _ in range(400)]

    def plain(html):
        html = re.sub(r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->", " ", html)
        html = re.sub(r"(?ia)</?(?:p|div|li|ul|ol|br|h[1-6]|tr|td|table|nav|article|section|header|footer|title|body|head|html)(?:\s[^>]*)?/?>", "\n", html)
        return re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f]+", " ", re.sub(r"<[^>]*>", "", html)))

    got = spark.createDataFrame(list(enumerate(pages)), "i bigint, html string").select("i", lines.page_lines(F.col("html")).alias("t")).collect()
    assert {r.i: r.t for r in got} == {i: plain(x) for i, x in enumerate(pages)}


def test_lines_are_hashed_once_when_boilerplate_goes(spark):
    docs = documents(spark, [row(i, f"{prose(20, i)}\nshared line here") for i in range(6)])
    found = lines.drop_boilerplate(docs, F.col("source"), dropped="gone")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") == 1
    assert all(r.gone == 1 and "shared" not in r.text for r in found.collect())


@pytest.mark.parametrize("name", ["op4", "op8"])
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    name, query = next((k, q) for k, q in queries.queries().items() if k.startswith(name + "_"))
    df = query(spark, SF_SMALL)
    cursor = con.execute(queries.oracle_sql()[name])
    at = [[c[0] for c in cursor.description].index(c) for c in df.columns]
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in cursor.fetchall())


def test_empty_tables(spark, tmp_root):
    documents(spark, []).write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_root}/pages.parquet")
    for name in ("op3_prob_minhash", "op6_chunk_passages", "op8_site_lines", "op4_blob_ledger_secrets"):
        assert queries.queries()[name](spark, tmp_root).count() == 0, name
    assert SCHEMA


def test_every_passage_holds_a_chunk_that_its_words_decide():
    """The anchor of a passage is one of its own chunks and the same in any context, also among equal words."""
    from cadence.llm.shingles import hash_words, words_of

    for passage in (prose(20, 77), "one two " * 10, "same " * 20):
        seen = set()
        for k in range(40):
            text = " ".join([prose(3 + k % 30, 100 + k), passage.strip(), prose(2 + k % 17, 200 + k)]).encode()
            data, ends = np.frombuffer(text, np.uint8), np.array([0, len(text)])
            at = len(prose(3 + k % 30, 100 + k).split())
            _, place, digest, check, anchor = substring.passages(data, ends, 20)
            here = int(np.flatnonzero(place == at)[0])
            starts, stops, _ = words_of(data, ends)
            own = substring.chunk_digests(hash_words(data, starts, stops), substring.chunk_words(20))[at : at + 19]
            assert anchor[here] in own[own != ~np.uint64(0)]
            seen.add((int(digest[here]), int(check[here]), int(anchor[here])))
        assert len(seen) == 1
    word = np.random.default_rng(5).integers(0, 1 << 63, 20_000).astype(np.uint64)
    begin, size = chunks.word_chunks(word, substring.chunk_words(20))
    assert set(size.tolist()) == {4, 5, 6} and np.diff(begin).max() <= chunks.SPREAD
    again, _ = chunks.word_chunks(np.concatenate([word[:9000], word[:5], word[9000:]]), 4)
    assert len({*begin.tolist()} - {*again[again < 9000].tolist(), *(again[again >= 9005] - 5).tolist()}) < 15
    with pytest.raises(ValueError):
        substring.chunk_words(10)


def test_lists_of_repeats_grow_with_the_rows_of_a_document(spark):
    """Equal rows of one document: each lists its passages once."""
    shared = prose(60, 3)
    rows = [row(1, shared)] + [row(2, prose(40, 4) + " " + shared)] * 50
    keyed = documents(spark, rows).selectExpr("text", "CAST(doc_id AS BIGINT) AS _doc", "xxhash64(doc_id, text) AS _row")
    listed = substring._listed(substring._repeated(keyed, "text", 20)).collect()
    assert len(listed) == 1 and len(listed[0]._repeats) <= 2 * 41
    got = substring.drop_repeated_passages(documents(spark, rows)).collect()
    assert len(got) == 51 and all(r.text.split() == prose(40, 4).split() for r in got if r.doc_id == 2)


def test_texts_that_repeat_nothing_are_not_shuffled(spark):
    """Rows whose bit is unset go past the join; carried columns may have any name."""
    hashes = spark.range(3000).select("id", F.xxhash64("id").alias("h"), F.lit("x").alias("_word"), F.lit("y").alias("_SET"))
    some = hashes.filter("id % 100 = 7")
    got = {r.id for r in substring._likely(hashes, "h", substring._words(some, "h")).collect()}
    assert {r.id for r in some.collect()} <= got and len(got) < 40
    passage = prose(40, 900)
    docs = documents(spark, [row(i, f"{prose(60, 1000 + i)} {passage if i < 3 else ''} {prose(30, 1100 + i)}") for i in range(30)])
    found = substring.drop_repeated_passages(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("LeftOuter") == 1
    assert {r.doc_id: (len(r.removed), r.repeats_of) for r in found.collect()} == {i: (1, [0]) if i in (1, 2) else (0, []) for i in range(30)}
