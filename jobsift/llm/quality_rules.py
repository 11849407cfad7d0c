"""Quality rules by weak supervision.

Rules vote *bad*, vote *good* or abstain on each document.  Nobody labels the
documents: expectation-maximisation estimates, from the votes alone, the share
of good documents and for each rule how often it votes bad on a bad and on a
good document.  The posterior probability of being good then replaces
"every rule must pass".

The votes of a corpus are first counted by pattern.  There are at most
``3 ** len(RULES)`` patterns whatever the corpus holds, so the estimation needs
one small aggregate; the model that comes out is a few numbers a rule.

Defined cases: a null or empty text has no word, fails the base check and is
not kept; repeated rows each get the same answer; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, id_text, rebatched, small_batches, stored, window_sums

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
#: Bytes of text that are counted at once; a byte is worth a number of 8 bytes meanwhile.
FEATURE_BYTES = 1 << 20

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_marks", "n_echo")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in FEATURES)


def _table(members: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


_SPACE = _table(b" \t\n\r\x0b\x0c")
_CONTINUED = np.array([0x80 <= x < 0xC0 for x in range(256)])
_UPPER = np.array([65 <= x < 91 for x in range(256)])
_LETTER = np.array([65 <= x < 91 or 97 <= x < 123 or x >= 0xC0 for x in range(256)])


def repeated_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    sums = window_sums(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), width)
    order = np.argsort(sums, kind="stable")
    same = sums[order][1:] == sums[order][:-1]
    if not same.any():
        return 0
    flags = np.zeros(n, bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    found: dict[tuple, int] = {}
    windows = [(int(i), tuple(words[i:i + width])) for i in np.flatnonzero(flags)]
    for _, w in windows:
        found[w] = found.get(w, 0) + 1
    inside = np.zeros(len(words), bool)
    for i, w in windows:
        if found[w] > 1:
            inside[i:i + width] = True
    return int(inside.sum())


def _features(batches: Iterator[pa.RecordBatch], within: str | None = None) -> Iterator[pa.RecordBatch]:
    """The first column of each row, which is handed on, with the counts of its
    text: the column ``text``, or the field ``within`` of the first column."""
    for batch in rebatched(batches, FEATURE_BYTES):
        names = [batch.schema.names[0], *FEATURES]
        texts = batch.column("text") if within is None else pc.fill_null(pc.struct_field(batch.column(0), within).cast(pa.string()), "")
        flat, offsets = flat_bytes(texts)
        counts = {}
        for name, table in (("space", _SPACE), ("continued", _CONTINUED), ("n_symbols", _table(SYMBOLS)), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_marks", _table(b"!"))):
            sums = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(table[flat], out=sums[1:])
            counts[name] = sums[offsets[1:]] - sums[offsets[:-1]]
        counts["word_chars"] = np.diff(offsets) - counts.pop("space") - counts.pop("continued")
        raw = flat.tobytes()
        more = {k: np.zeros(batch.num_rows, np.int64) for k in FEATURES if k not in counts}
        for i in range(batch.num_rows):
            text = raw[offsets[i]:offsets[i + 1]]
            words = text.split()
            lines = [x for x in text.split(b"\n") if x.strip()]
            more["n_words"][i] = len(words)
            more["n_lines"][i] = len(lines)
            more["n_dup_lines"][i] = len(lines) - len(set(lines))
            more["n_repeat_words"][i] = repeated_words(words)
            more["n_distinct"][i] = len(distinct := set(words))
            more["n_echo"][i] = sum(map(bytes.__eq__, words, words[1:])) if len(distinct) < len(words) else 0
        counts |= more
        yield pa.RecordBatch.from_arrays([batch.column(names[0]), *(pa.array(counts[k], pa.int64()) for k in FEATURES)], names)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each whole text; one row for each row of ``docs``."""
    return id_text(docs, id_col, text_col).mapInArrow(_features, SCHEMA)


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def rules() -> list[tuple[str, Column, Column]]:
    """(name, votes bad, votes good); neither: the rule abstains.  Thresholds
    are shares of words, lines or letters.  Signals of one defect make one rule,
    as the estimation takes rules to err independently."""
    variety = _ratio("n_distinct", "n_words")
    return [
        ("symbols", _ratio("n_symbols", "n_words") > 0.3, _ratio("n_symbols", "n_words") < 0.02),
        ("repetition", (_ratio("n_repeat_words", "n_words") > 0.25) | (_ratio("n_echo", "n_words") > 0.2) | ((F.col("n_words") >= 40) & (variety < 0.2)), (_ratio("n_repeat_words", "n_words") < 0.05) & (_ratio("n_echo", "n_words") < 0.03) & (variety > 0.3)),
        ("shouting", (_ratio("n_upper", "n_letters") > 0.4) | (_ratio("n_marks", "n_words") > 0.25), (_ratio("n_upper", "n_letters") < 0.15) & (_ratio("n_marks", "n_words") < 0.02)),
        ("same_lines", (F.col("n_lines") >= 4) & (_ratio("n_dup_lines", "n_lines") > 0.5), (F.col("n_lines") >= 2) & (F.col("n_dup_lines") == 0)),
        ("word_length", ~(_ratio("word_chars", "n_words").between(2.5, 15)), _ratio("word_chars", "n_words").between(3.5, 10)),
        ("length", F.col("n_words") < 10, F.col("n_words") >= 40),
    ]


def with_votes(counted: DataFrame) -> DataFrame:
    """``votes``: one character a rule, ``b`` bad, ``g`` good, ``-`` abstains."""
    return counted.withColumn("votes", F.concat(*(F.when(bad, "b").when(good, "g").otherwise("-") for _, bad, good in rules())))


#: Prior knowledge: a rule wrongly votes bad on this share of the good documents at most.
MOST_FALSE = 0.005


def fit(patterns: list[tuple[str, int]], rounds: int = 60, tolerance: float = 1e-9) -> dict:
    """Expectation-maximisation over vote patterns and their counts.

    ``prior``: share of good documents; ``bad_if_bad`` and ``bad_if_good``: for
    each rule the probability that its vote, when it votes, is bad.  It starts
    from "a bad vote means a bad document" and every estimate is smoothed by
    a vote or two, so rules that never vote stay near their start.  The bound
    ``MOST_FALSE`` keeps the two classes from settling on one frequent kind of
    defect while the others count as noise of good documents.
    """
    n_rules = len(rules())
    if not patterns:
        return {"prior": 0.5, "bad_if_bad": [0.5] * n_rules, "bad_if_good": [0.5] * n_rules, "rounds": 0}
    bad = np.array([[x == "b" for x in p] for p, _ in patterns], float)
    good = np.array([[x == "g" for x in p] for p, _ in patterns], float)
    weight = np.array([n for _, n in patterns], float)
    p_good = np.where(bad.any(axis=1), 0.05, 0.95)
    before = -math.inf
    for step in range(1, rounds + 1):
        w_good, w_bad = weight * p_good, weight * (1 - p_good)
        prior = (w_good.sum() + 1) / (weight.sum() + 2)
        if_good = np.minimum((w_good @ bad + 0.01) / (w_good @ (bad + good) + 2), MOST_FALSE)
        if_bad = (w_bad @ bad + 0.7) / (w_bad @ (bad + good) + 2)
        if_bad = np.maximum(if_bad, if_good)  # a bad vote never speaks for a document
        like_good = math.log(prior) + bad @ np.log(if_good) + good @ np.log(1 - if_good)
        like_bad = math.log(1 - prior) + bad @ np.log(if_bad) + good @ np.log(1 - if_bad)
        total = np.logaddexp(like_good, like_bad)
        p_good = np.exp(like_good - total)
        now = float(weight @ total)
        if abs(now - before) <= tolerance * abs(now):
            break
        before = now
    return {"prior": float(prior), "bad_if_bad": if_bad.tolist(), "bad_if_good": if_good.tolist(), "rounds": step}


def posterior(model: dict) -> Column:
    """The probability that a document with these ``votes`` is good."""
    odds: Column = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for i, (b, g) in enumerate(zip(model["bad_if_bad"], model["bad_if_good"], strict=True)):
        vote = F.substring("votes", i + 1, 1)
        odds = odds + F.when(vote == "b", math.log(g / b)).when(vote == "g", math.log((1 - g) / (1 - b))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judged(counted: DataFrame, threshold: float) -> DataFrame:
    """``counted`` with ``votes``, ``p_good``, ``base_failed`` and ``kept``."""
    counted = stored(with_votes(counted), "quality-votes")
    model = fit([(r["votes"], r["n"]) for r in counted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = counted.withColumn("p_good", posterior(model)).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs``' ids with counts, votes, ``p_good`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated
    windows.  ``kept``: false if so, else whether ``p_good >= threshold``.
    """
    return judged(features(docs, id_col, text_col), threshold)


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Each row is judged by itself; its columns travel with its counts, so no
    join brings the two together and null or repeated ids do no harm.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("kept_row"))
    schema = T.StructType([rows.schema["kept_row"], *(T.StructField(c, T.LongType()) for c in FEATURES)])
    return judged(rows.mapInArrow(lambda batches: _features(batches, text_col), schema), threshold).where("kept").select("kept_row.*")
