"""Quality rules as weak supervision.

Rules vote good or bad, or abstain. Expectation-maximisation over the votes of
all documents estimates how often each rule votes each way on good and on bad
documents, and the share of good ones; a document's posterior probability of
being good replaces the demand that it pass every rule. Votes are counted by
pattern, so the fit works on at most 3^rules numbers, however many documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import arrow_schema, materialise, slices, text_buffer

#: Fixed values of the base measures: white space that parts words, and symbols.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
#: Base rule: too few words, or too many of them in repeated 3-word windows (per cent).
LEAST_WORDS, MOST_REPEATED = 50, 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct_words", "n_bare_marks")


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    return table


_IS_SPACE = _class(SPACES)
_IS_SYMBOL = _class(SYMBOLS)
_IS_UPPER = _class(bytes(range(65, 91)))
_IS_LETTER = _class(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]))
#: Marks that are a word of their own, or doubled exclamation marks, count as bare.
_IS_MARK = _class(b"|#*$%&<>-_=+~^/\\!?.,:;")
_IS_CHAR = 1 - _class(bytes(range(0x80, 0xC0)))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends[1:]] - total[ends[:-1]]


def _repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    count, upto = 0, 0
    for i, window in enumerate(windows):
        if window in twice:
            count += i + 3 - max(i, upto)
            upto = i + 3
    return count


def _repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those among them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def measures(column: pa.Array) -> list[np.ndarray]:
    """The values of MEASURES for each text."""
    data, ends = text_buffer(column)
    space = _IS_SPACE[data]
    begins = np.concatenate([[1], space[:-1]]) if len(data) else space.copy()
    begins[ends[:-1][ends[:-1] < len(data)]] = 1  # a text's first character follows nothing
    n_words = _sums(begins * (1 - space), ends)
    word_chars = _sums(_IS_CHAR[data] * (1 - space), ends)
    raw = data.tobytes()
    ends_word = np.concatenate([space[1:], [1]]) if len(data) else space.copy()
    ends_word[ends[1:][ends[1:] > 0] - 1] = 1
    shout = (data[1:] == 33) & (data[:-1] == 33) if len(data) > 1 else np.zeros(0, bool)
    bare = _IS_MARK[data] * begins * ends_word
    bare[:-1] += shout
    own = np.zeros((4, len(n_words)), np.int64)
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        text = raw[a:b]
        words = text.split()
        n_lines, n_dup = _repeated_lines(text)
        own[:, i] = n_dup, _repeated_words(words), n_lines, len(set(words))
    return [n_words, word_chars, _sums(_IS_SYMBOL[data], ends), own[0], own[1], own[2], _sums(_IS_UPPER[data], ends),
            _sums(_IS_LETTER[data], ends), own[3], _sums(bare, ends)]


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes: -1 bad, 1 good, 0 abstains. All but length abstain on texts under 10 words."""
    words, letters = F.greatest("n_words", F.lit(1)), F.greatest("n_letters", F.lit(1))
    some = F.col("n_words") >= 10
    share = lambda a, b: F.col(a) / b
    checked = {
        "symbols": (share("n_symbols", words) > 0.3, share("n_symbols", words) < 0.05),
        "marks": (share("n_bare_marks", words) > 0.2, share("n_bare_marks", words) < 0.05),
        "letters": (share("n_letters", F.greatest("word_chars", F.lit(1))) < 0.7, share("n_letters", F.greatest("word_chars", F.lit(1))) > 0.85),
        "capitals": (share("n_upper", letters) > 0.5, share("n_upper", letters) < 0.2),
        "repeats": (share("n_repeat_words", words) > 0.3, share("n_repeat_words", words) < 0.15),
        "variety": ((share("n_distinct_words", words) < 0.2) & (F.col("n_words") < 2000), share("n_distinct_words", words) > 0.3),
        "lines": (share("n_dup_lines", F.greatest("n_lines", F.lit(1))) > 0.3, (F.col("n_lines") > 1) & (F.col("n_dup_lines") == 0)),
        "word_length": ((share("word_chars", words) < 2.5) | (share("word_chars", words) > 14), share("word_chars", words).between(3, 10)),
    }
    votes = {"length": _vote(F.col("n_words") < LEAST_WORDS, F.col("n_words") >= 100)}
    return votes | {name: F.when(some, _vote(bad, good)).otherwise(0) for name, (bad, good) in checked.items()}


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fit(votes: np.ndarray, known_bad: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns: log odds of good, and each rule's log-likelihood ratios.

    ``votes`` has a row of -1, 0, 1 for each pattern and ``counts`` its number
    of documents; patterns in ``known_bad`` fail the base rule and stay bad.
    A rule's accuracies are its rates of each vote among good and among bad
    documents, with a prior worth a hundredth of the documents which holds
    that bad votes are rare among good ones. A vote never counts against its
    own side, and a rule that abstains adds nothing. Returns the prior log odds and, per rule, the
    log-likelihood ratio of a bad and of a good vote.
    """
    total = counts.sum()
    weight = max(1.0, total / 100)
    prior_good, prior_bad = weight * np.array([0.01, 0.09, 0.90]), weight * np.array([0.40, 0.20, 0.40])
    posterior = np.where(known_bad | ((votes == -1).sum(1) >= 1), 0.05, 0.95)
    posterior[known_bad] = 0.0
    odds, ratios = 0.0, np.zeros((votes.shape[1], 2))
    for _ in range(rounds):
        good, bad = posterior * counts, (1 - posterior) * counts
        share = (good.sum() + 0.9 * weight) / (total + weight)
        odds = np.log(share / (1 - share))
        rate = lambda mass, prior: np.stack([[mass[votes[:, j] == v].sum() for v in (-1, 0, 1)] for j in range(votes.shape[1])]) + prior
        of_good, of_bad = rate(good, prior_good), rate(bad, prior_bad)
        of_good, of_bad = of_good / of_good.sum(1, keepdims=True), of_bad / of_bad.sum(1, keepdims=True)
        log = np.log(of_good / of_bad)
        ratios = np.stack([np.minimum(log[:, 0], 0), np.maximum(log[:, 2], 0)], 1)
        score = odds + ((votes == -1) * ratios[:, 0] + (votes == 1) * ratios[:, 1]).sum(1)
        new = np.where(known_bad, 0.0, 1 / (1 + np.exp(-score)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return float(odds), ratios


def _measured(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            values = [pa.array(x, pa.int64()) for x in measures(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *values], names=[*names, *MEASURES])

    return run


RESULT = (*MEASURES, "base_failed", "p_good", "kept")


def judge(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """Carried columns, MEASURES, votes ``vote_<rule>``, ``base_failed``, ``p_good`` and ``kept``.

    ``kept`` is false where the base rule fails, else whether the posterior is
    at least ``threshold``. A null text has no words, as an empty one, and so
    fails. Equal texts are judged equally. An empty table gives no rows. A
    carried column with the name of a result gives way.
    """
    votes = {f"vote_{k}": v for k, v in rules().items()}
    rows = docs.select(text, *[c for c in carry if c != text and c not in RESULT and c not in votes])
    names = [c for c in rows.columns if c in carry]
    kept = arrow_schema(rows, names)
    schema = (kept + ", " if kept else "") + ", ".join(f"{m} bigint" for m in MEASURES)
    seen = materialise(rows.mapInArrow(_measured(text, names), schema), "quality").withColumns(votes | {"base_failed": base_failed()})
    patterns = seen.groupBy(*votes, "base_failed").count().toPandas()  # at most 2 * 3^rules rows
    if not len(patterns):
        return seen.withColumns({"p_good": F.lit(0.0), "kept": F.lit(False)})
    odds, ratios = fit(patterns[list(votes)].to_numpy(), patterns.base_failed.to_numpy(bool), patterns["count"].to_numpy(float))
    score = F.lit(odds)
    for name, (bad, good) in zip(votes, ratios.tolist(), strict=True):
        score = score + F.when(F.col(name) == -1, bad).when(F.col(name) == 1, good).otherwise(0.0)
    p_good = F.when(F.col("base_failed"), 0.0).otherwise(1 / (1 + F.exp(-score)))
    return seen.withColumn("p_good", p_good).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
