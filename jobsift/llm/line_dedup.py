"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes if the same line, or one within ``max_edits`` character edits, is
found earlier (smaller document id, or the same document above).  Lines of
white space stay; lines under ``min_chars`` characters are compared exactly.
``max_edits`` is one number, or ``(characters, edits)`` steps: of two lines the
shorter one's length decides how many edits count as near.

Exact copies collapse first, so only distinct lines enter the join.  Each is
cut into ``max_edits + 1`` segments; two lines within the threshold share a
segment, in places that differ little.  A line is indexed under (its length,
segment number, segment) and probes the indexes of its own and of up to
``max_edits`` smaller lengths with the substrings that can match there: those
allowed both from the left end (the edits before segment i are i - 1 at most)
and from the right.  Only keys, 64-bit hashes, are shuffled; the text is fetched
for lines that share a key.  A shared key is checked in the join condition, by
finer segments and then by the banded edit distance of what lies between equal
ends, so unverified pairs are never rows.  Segments are cut out of four bytes a
character.

Defined cases: a null or empty text has no line; rows with the same id and
text are one document (each row loses the same lines); different texts under
one id are ordered by their hash; a null id comes before all others; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEAST = -(1 << 63)
#: Production steps: edits that count as near, from so many characters of the shorter line on.
EDITS = ((20, 2), (400, 3))
Edits = int | tuple[tuple[int, int], ...]


def steps_of(max_edits: Edits, min_chars: int) -> list[tuple[int, int, int]]:
    """(least length, length that is over it, edits) of each step."""
    steps = [(min_chars, max_edits)] if isinstance(max_edits, int) else [(max(n, min_chars), k) for n, k in max_edits]
    return [(low, high, most) for (low, most), (high, _) in pairwise([*steps, (1 << 31, 0)]) if low < high]


def _edits_within(a: str, b: str, most: int) -> str:
    return f"abs(length({a}) - length({b})) <= {most} AND levenshtein({a}, {b}, {most}) >= 0"


def edits_within(a: str, b: str, most: int) -> Column:
    """Whether two string columns are within ``most`` edits."""
    return F.expr(_edits_within(a, b, most))


FINER = 16


def characters(text: str) -> Column:
    """A string as four bytes a character: a substring of it is one copy, while
    one of a string counts characters from the beginning."""
    return F.encode(F.col(text), "UTF-32")


def _cut(code: str, first: str, size: str) -> str:
    """``size`` characters of ``code`` from place ``first`` on."""
    return f"substring({code}, CAST(4 * ({first}) + 1 AS INT), CAST(4 * ({size}) AS INT))"


def finer_segments_met(most: int) -> str:
    """Whether all but ``most`` of the FINER segments of the text ``a_code`` stand
    in ``b_code`` where they can, ``most`` characters aside at most.  It is true
    of every pair within ``most`` edits, as an edit spoils one segment."""
    first, size = f"((i * a_chars) div {FINER})", f"(((i + 1) * a_chars) div {FINER} - (i * a_chars) div {FINER})"
    around = _cut("b_code", f"greatest({first} - {most}, 0)", f"{size} + {2 * most}")
    return f"size(filter(sequence(0, {FINER - 1}), i -> NOT contains({around}, {_cut('a_code', first, size)}))) <= {most}"


def rest_within(most: int) -> str:
    """Whether ``a_code`` and ``b_code`` are within ``most`` edits.  What both
    begin and end with, in blocks, takes no part in the edits, so the distance is
    that of the texts between.  The lambdas name values: they are worked out once."""
    block = f"(a_chars div {FINER})"
    equal = lambda at: f"coalesce(nullif(array_position(transform(sequence(0, {FINER - 1}), i -> substring(a_code, CAST({at} AS INT), CAST(4 * {block} AS INT)) = substring(b_code, CAST({at} AS INT), CAST(4 * {block} AS INT))), false), 0) - 1, {FINER})"
    same = f"array(named_struct('begin', {equal(f'4 * i * {block} + 1')}, 'end', {equal(f'-4 * (i + 1) * {block}')}))"
    between = ", ".join(f"'{x}', decode({_cut(f'{x}_code', f's.begin * {block}', f'{x}_chars - least(s.begin + s.end, {FINER}) * {block}')}, 'UTF-32')" for x in "ab")
    return f"exists(transform({same}, s -> named_struct({between})), t -> {_edits_within('t.a', 't.b', most)})"


def near_lines(steps: list[tuple[int, int, int]]) -> Column:
    """Whether the texts ``a_code``, the shorter one, and ``b_code`` are within
    the edits of its step; ``a_chars`` and ``b_chars`` are their lengths."""
    near = F.lit(False)
    for low, high, most in steps:
        near = F.when(F.expr(f"a_chars >= {low} AND a_chars < {high}"), F.expr(f"b_chars - a_chars BETWEEN 0 AND {most} AND {finer_segments_met(most)} AND {rest_within(most)}")).otherwise(near)
    return near


def segment_places(chars: str, steps: list[tuple[int, int, int]]) -> Column:
    """Array of (less, parts, part, shift) of a line of ``chars`` characters: the
    segment ``part`` of ``parts`` of a text ``less`` characters shorter, looked for
    ``shift`` characters on.  The line's own segments, those that are indexed, have
    neither; the others are where it probes the indexes of its own and smaller
    lengths.  As fixed arrays by length, the generated code stays small however
    many places there are."""
    places = [(least + less, over + less, [(less, most + 1, part, shift) for part in range(1, most + 2) for shift in range(max(-(part - 1), less - (most + 1 - part)), min(part - 1, less + (most + 1 - part)) + 1)]) for least, over, most in steps for less in range(most + 1)]
    out = "CAST(array() AS array<struct<less:int,parts:int,part:int,shift:int>>)"
    bounds = sorted({x for least, over, _ in places for x in (least, over)})
    cases = []
    for low, high in pairwise(bounds):
        here = [p for least, over, found in places if least <= low and high <= over for p in found]
        if here:
            cases.append(f"WHEN {chars} >= {low} AND {chars} < {high} THEN array({', '.join(f'named_struct({chr(39)}less{chr(39)}, {l}, {chr(39)}parts{chr(39)}, {n}, {chr(39)}part{chr(39)}, {i}, {chr(39)}shift{chr(39)}, {d})' for l, n, i, d in here)})")
    return F.expr(f"CASE {' '.join(cases)} ELSE {out} END")


def segment_keys(lines: DataFrame, steps: list[tuple[int, int, int]]) -> DataFrame:
    """(key, indexed, h1) of the segments of ``lines`` (h1, code, chars) and of
    the substrings with which they probe; none where one would begin before the line."""
    placed = lines.select("h1", "code", "chars", F.inline(segment_places("chars", steps)))
    placed = placed.withColumns({"n": F.expr("chars - less"), "first": F.expr("((part - 1) * (chars - less)) div parts"), "after": F.expr("(part * (chars - less)) div parts")}).where("first + shift >= 0")
    return placed.select(F.expr(f"xxhash64(n, part, {_cut('code', 'first + shift', 'after - first')})").alias("key"), F.expr("less = 0 AND shift = 0").alias("indexed"), "h1")


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, place, line) of each line that has more than white space."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.split(text, "\n", -1).alias("lines"))
    return keyed.select("doc_id", "text_key", F.posexplode("lines").alias("place", "line")).where(r"line RLIKE '[^ \\t-\\r]'")


def _hash() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2")]


def links(docs: DataFrame, max_edits: Edits, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes of equal lines with their first place, verified links between
    classes in both directions)."""
    steps = steps_of(max_edits, min_chars)
    lines = lines_of(docs, id_col, text_col)
    # min of the place: combined before the shuffle.
    classes = stored(lines.select(*_hash(), F.struct("doc_id", "text_key", "place").alias("at")).groupBy("h1", "h2").agg(F.min("at").alias("at")), "line-classes")
    # A key travels with one hash of its line only; copies of a line are one row of a key.
    rows = lines.select(_hash()[0], "line", F.length("line").alias("chars")).where(F.col("chars") >= steps[0][0])
    rows = segment_keys(rows.select("h1", characters("line").alias("code"), "chars"), steps)
    # A key is of use if two lines have it, one of them in the index.
    by_key = Window.partitionBy("key")
    used = rows.withColumns({"least": F.min("h1").over(by_key), "most": F.max("h1").over(by_key), "any_indexed": F.max("indexed").over(by_key)}).where("least < most AND any_indexed")
    shared = stored(used.groupBy("key", "h1").agg(F.max("indexed").alias("indexed")), "line-keys")
    wanted = classes.join(shared.select("h1").distinct(), "h1", "left_semi").groupBy("at.doc_id", "at.text_key").agg(F.collect_list(F.struct("at", "h1", "h2")).alias("wanted"))  # lines of one document
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.split(text, "\n", -1).alias("lines"))
    texts = source.join(wanted.hint("shuffle_hash"), ["doc_id", "text_key"]).select(F.explode("wanted").alias("w"), "lines").select("w.at", "w.h1", "w.h2", F.expr("lines[w.at.place]").alias("line")).distinct().withColumn("chars", F.length("line"))
    held = stored(shared.join(texts, "h1"), "line-texts")
    held = held.withColumn("code", characters("line")).drop("line")
    a = held.where("indexed").select("key", *(F.col(c).alias(f"a_{c}") for c in ("h1", "h2", "at", "code", "chars")))
    b = held.select("key", *(F.col(c).alias(f"b_{c}") for c in ("h1", "h2", "at", "code", "chars")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    other = F.expr("NOT (a_h1 = b_h1 AND a_h2 = b_h2)")
    pairs = a.repartition(parts, "key").join(b.repartition(parts, "key"), (a["key"] == b["key"]) & other & near_lines(steps))
    found = pairs.select(F.col("a_h1").alias("a1"), F.col("a_h2").alias("a2"), "a_at", F.col("b_h1").alias("b1"), F.col("b_h2").alias("b2"), "b_at")
    found = stored(found.distinct(), "line-links")
    both = found.union(found.select("b1", "b2", "b_at", "a1", "a2", "a_at")).distinct()
    return classes.select("h1", "h2", "at"), both


def line_verdicts(docs: DataFrame, max_edits: Edits = 1, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document (id and text): doc_id, text_key, n_lines, n_copies,
    n_near (lines that go as exact and as near copies), n_links (near lines of
    other wording that its lines have), gone (places of the lines that go)."""
    classes, both = links(docs, max_edits, min_chars, id_col, text_col)
    linked = both.groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.count("*").alias("links"), F.max(F.expr("b_at < a_at")).alias("near"))
    judged = stored(classes.join(linked, ["h1", "h2"], "left").select("h1", "h2", F.col("at").alias("first"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("near", F.lit(False)).alias("near")), "line-verdicts")
    lines = lines_of(docs, id_col, text_col).select("doc_id", "text_key", "place", *_hash())
    copy = F.expr("NOT (first = struct(doc_id, text_key, place))")
    marked = lines.join(judged, ["h1", "h2"]).select("doc_id", "text_key", "place", "links", copy.alias("copy"), (~copy & F.col("near")).alias("near")).distinct()
    return marked.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_lines"), F.sum(F.col("copy").cast("long")).alias("n_copies"), F.sum(F.col("near").cast("long")).alias("n_near"), F.sum("links").alias("n_links"), F.sort_array(F.collect_list(F.when(F.col("copy") | F.col("near"), F.col("place")))).alias("gone"))


def dedup_report(docs: DataFrame, max_edits: Edits = 1, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_lines, n_copies, n_near, n_links, gone."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_id"), F.xxhash64(text).alias("text_key"))
    out = every.join(line_verdicts(docs, max_edits, min_chars, id_col, text_col), ["doc_id", "text_key"], "left")
    return out.select(F.when(F.col("doc_id") != LEAST, F.col("doc_id")).alias("doc_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_copies", "n_near", "n_links")), F.coalesce("gone", F.expr("CAST(array() AS array<int>)")).alias("gone"))


def remove_lines(docs: DataFrame, max_edits: Edits = 1, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that go, all columns in place; rows that lose
    nothing keep their text as it is, null included."""
    gone = stored(line_verdicts(docs, max_edits, min_chars, id_col, text_col).where("size(gone) > 0").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone"), "lines-gone")
    names = docs.columns
    rows = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), F.coalesce(docs[id_col].cast("long"), F.lit(LEAST)).alias("gone_id"), F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("gone_key"))
    kept = F.expr(f"array_join(filter(split(row.`{text_col}`, '\\n', -1), (x, i) -> NOT array_contains(gone, i)), '\\n')")
    joined = rows.join(gone.hint("shuffle_hash"), ["gone_id", "gone_key"], "left")
    return joined.select(*(F.when(F.col("gone").isNotNull(), kept).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names))
