"""Repeated runs of lines removed by content-defined chunks, in DataFrame functions only.

A rolling hash over the hashes of two neighbouring lines is computed for every line; a chunk
starts where it has a local minimum, so chunks hold two lines or more and the same passage is cut
at the same places wherever it stands. A line of `OWN_LINE_WORDS` words or more is a chunk by
itself: it is a passage of its own.

Boundaries leave the ends of a repeated passage outside its whole chunks, and a passage of a few
lines may have none. So every line also begins and ends a run: the fewest lines with words that
hold more than `RUN_WORDS` words together. Where a run is cut depends on its own lines alone, and
each line of a repeated passage of more words lies in a run within that passage. Blank lines do
not count in a run, but those between its lines go with it.

A chunk or run whose line hashes occur more than once in the corpus is kept where it comes first
(by doc_id, text, line) and removed elsewhere, once the bytes of all its occurrences have been
compared. The first place of any line stays. Repeated single lines below `OWN_LINE_WORDS` words
are not looked at by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import materialised
from .common import unused

OWN_LINE_WORDS = 25
RUN_WORDS = 50
# Runs have keys of their own, so a chunk and a run never meet.
RUN_MARK = "run"
# Bytes of a word, as for the other text operators.
WORD = r"[^\\x20\\x09-\\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    return docs.where("text IS NOT NULL").select(
        F.col("doc_id").alias("owner_id"), F.md5(F.col("text").cast("binary")).alias("content"),
        F.split("text", "\n", -1).alias("lines"),
    )


def chunks(docs: DataFrame, own_line_words: int = OWN_LINE_WORDS) -> DataFrame:
    """(owner_id, content, start, stop, chunk): the chunks and runs that may be removed if they repeat."""
    lined = _lines(docs).selectExpr(
        "owner_id", "content", "transform(lines, x -> md5(cast(x AS binary))) AS hashes",
        f"transform(lines, x -> regexp_count(x, '{WORD}')) AS words",
    )
    numbered = lined.selectExpr(
        "*", f"transform(words, w -> w >= {own_line_words}) AS long",
        "transform(hashes, h -> cast(conv(substring(h, 1, 8), 16, 10) AS bigint)) AS number",
        "filter(transform(words, (w, i) -> struct(i AS line, w AS words, hashes[i] AS hash)), x -> x.words > 0) AS told",
    )
    rolled = numbered.selectExpr(
        "owner_id", "content", "hashes", "long", "told", "size(hashes) AS n",
        "transform(number, (x, i) -> (if(i > 0, number[i - 1], 0L) * 31 + x) % 1000003) AS roll",
    )
    begun = rolled.selectExpr(
        "owner_id", "content", "hashes", "long", "told", "n",
        "filter(sequence(0, n - 1), i -> i = 0 OR long[i] OR long[i - 1] OR "
        "(i < n - 1 AND roll[i] < roll[i - 1] AND roll[i] <= roll[i + 1])) AS starts",
    )
    spans = begun.selectExpr(
        "owner_id", "content", "hashes", "told", "n",
        "filter(transform(starts, (s, k) -> struct(s AS start, "
        "if(k + 1 < size(starts), starts[k + 1], n) AS stop)), "
        "c -> c.stop - c.start > 1 OR long[c.start]) AS spans",
        f"{_runs_from('k', 'slice(told, k + 1, {0})', 'k')} AS ahead",
        f"{_runs_from('k', 'reverse(slice(told, greatest(k - {0} + 1, 0) + 1, least(k + 1, {0})))', 'k - r.n + 1')} AS behind",
    )
    # Lines that are long enough go by themselves; only runs with a shorter one add anything.
    short = spans.withColumn("runs", F.expr(
        "transform(filter(array_union(ahead, behind), r -> r % 64 > 1 AND "
        f"exists(slice(told, cast(r div 64 AS int) + 1, cast(r % 64 AS int)), x -> x.words < {own_line_words})), "
        "r -> struct(cast(r div 64 AS int) AS first, cast(r % 64 AS int) AS n))"
    ))
    keyed = short.selectExpr(
        "owner_id", "content",
        "concat(transform(spans, c -> struct(c.start AS start, c.stop AS stop, "
        "md5(cast(array_join(slice(hashes, c.start + 1, c.stop - c.start), ',') AS binary)) AS chunk)), "
        "transform(runs, r -> struct(told[r.first].line AS start, told[r.first + r.n - 1].line + 1 AS stop, "
        f"concat('{RUN_MARK}', md5(cast(array_join(transform(slice(told, r.first + 1, r.n), x -> x.hash), ',') "
        "AS binary))) AS chunk))) AS found",
    )
    # The outer form, as for the inner one the planner would repeat the whole array in a filter.
    return keyed.select("owner_id", "content", F.inline_outer("found")).where("chunk IS NOT NULL")


def _runs_from(place: str, lines: str, first: str) -> str:
    """SQL of the runs that start (or end) at the lines with words, as 64 * first line + lines.

    Each such line has a word, so the next `RUN_WORDS` + 1 are enough to look at. A run is one
    number, since sets of numbers are made by hashing and sets of structs by comparing all.
    """
    run = (
        f"aggregate({lines.format(RUN_WORDS + 1)}, struct(0 AS sum, 0 AS n), (a, x) -> "
        f"if(a.sum > {RUN_WORDS}, a, struct(a.sum + x.words AS sum, a.n + 1 AS n)))"
    )
    each = f"transform(told, (t, {place}) -> if(t.words > {RUN_WORDS}, struct(t.words AS sum, 1 AS n), {run}))"
    return f"filter(transform({each}, (r, k) -> if(r.sum > {RUN_WORDS}, ({first}) * 64L + r.n, -1L)), r -> r >= 0)"


def repeats(docs: DataFrame, own_line_words: int = OWN_LINE_WORDS) -> DataFrame:
    """(owner_id, content, spans): per document (an id and the md5 of its text) what to remove."""
    place = F.struct(F.col("owner_id").isNull().alias("owner_null"), "owner_id", "content", "start")
    found = materialised(chunks(docs, own_line_words))
    shared = materialised(
        found.groupBy("chunk").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last").select("chunk", "first")
    )
    hits = materialised(
        found.join(shared, "chunk")
        .select("chunk", "owner_id", "content", "start", "stop", (place == F.col("first")).alias("kept"))
    )
    asked = materialised(
        hits.groupBy("owner_id", "content").agg(F.collect_set(F.struct("chunk", "start", "stop")).alias("asked"))
    )
    texts = _joined(_lines(docs), asked, "inner").select(
        F.expr("inline_outer(transform(asked, c -> struct(c.chunk AS chunk, array_join(filter("
               f"slice(lines, c.start + 1, c.stop - c.start), x -> NOT startswith(c.chunk, '{RUN_MARK}') "
               f"OR x RLIKE '{WORD}'), '\n') AS bytes)))")
    )
    unlike = materialised(
        texts.groupBy("chunk").agg(F.min("bytes").alias("least"), F.max("bytes").alias("most"))
        .where("least <> most").select("chunk")
    )
    gone = hits.where("NOT kept").join(unlike, "chunk", "left_anti")
    return materialised(
        gone.groupBy("owner_id", "content")
        .agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    )


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"owner_id": "that_id", "content": "that_content"})
    same = F.col("owner_id").eqNullSafe(F.col("that_id")) & (F.col("content") == F.col("that_content"))
    return left.join(right, same, how)


def without_repeats(docs: DataFrame, own_line_words: int = OWN_LINE_WORDS,
                    counts: tuple[str, str] | None = None) -> DataFrame:
    """All rows of `docs` with repeated chunks and runs of lines taken out of `text`.

    Columns stay as they are, but for `text`, for `n_chars` (characters of the new text, where the
    table has it and lines went) and for two counts, all lines and removed lines, under the names
    in `counts`. Null texts stay null, without lines; empty texts have one empty line. Rows with
    equal id and text are one document and treated alike; null ids come last in the order of
    first places. A text of which all goes becomes empty. An empty table stays empty.
    """
    names = {k: unused(docs, f"_{k}") for k in ("id", "content", "spans", "lines", "gone")}
    spans = repeats(docs, own_line_words).select(
        F.col("owner_id").alias(names["id"]), F.col("content").alias(names["content"]),
        F.col("spans").alias(names["spans"]),
    )
    same = (
        docs["doc_id"].eqNullSafe(F.col(names["id"]))
        & (F.md5(docs["text"].cast("binary")) == F.col(names["content"]))
    )
    both = docs.join(spans, same, "left").withColumn(names["lines"], F.split("text", "\n", -1))
    # Spans are in ascending order; each adds the lines behind the one before.
    spans_of = f"`{names['spans']}`"
    gone = F.expr(
        f"array_distinct(flatten(transform({spans_of}, (c, k) -> CASE "
        "WHEN k = 0 THEN sequence(c.start, c.stop - 1) "
        f"WHEN {spans_of}[k - 1].stop >= c.stop THEN cast(array() AS array<int>) "
        f"ELSE sequence(greatest(c.start, {spans_of}[k - 1].stop), c.stop - 1) END)))"
    )
    both = both.withColumn(names["gone"], gone)
    lines, out = f"`{names['lines']}`", f"`{names['gone']}`"
    kept = F.expr(
        f"array_join(transform(array_except(sequence(0, size({lines}) - 1), {out}), i -> {lines}[i]), '\n')"
    )
    cut = F.col(names["gone"]).isNotNull()
    both = both.withColumn("text", F.when(cut, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        both = both.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    more = []
    if counts:
        more = [
            F.when(F.col(names["lines"]).isNull(), 0).otherwise(F.size(names["lines"])).cast("long").alias(counts[0]),
            F.when(cut, F.size(names["gone"])).otherwise(0).cast("long").alias(counts[1]),
        ]
    return both.select(*docs.columns, *more)


CHECK = f"""
WITH d AS (
  SELECT doc_id, md5(text) AS content, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), h AS (
  SELECT *, list_transform(lines, lambda x: md5(x)) AS hashes,
         list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))) AS words,
         list_transform(words, lambda w: w >= {OWN_LINE_WORDS}) AS long,
         len(lines) AS n FROM d
), v AS (
  SELECT *, list_transform(hashes, lambda x: CAST('0x' || substr(x, 1, 8) AS BIGINT)) AS number FROM h
), r AS (
  SELECT *, list_transform(range(1, n + 1), lambda i:
    ((CASE WHEN i > 1 THEN number[i - 1] ELSE 0 END) * 31 + number[i]) % 1000003) AS roll FROM v
), b AS (
  SELECT *, list_filter(range(1, n + 1), lambda i: i = 1 OR long[i] OR long[i - 1] OR
    (i < n AND roll[i] < roll[i - 1] AND roll[i] <= roll[i + 1])) AS starts FROM r
), c AS (
  SELECT doc_id, content, lines, hashes, long, unnest(list_zip(starts, list_append(starts[2:], n + 1))) AS c FROM b
), k AS (
  SELECT doc_id, content, c[1] AS start, c[2] AS stop, array_to_string(lines[c[1]:c[2] - 1], chr(10)) AS bytes
  FROM c WHERE c[2] - c[1] > 1 OR long[c[1]]
), o AS (
  SELECT *, row_number() OVER (PARTITION BY bytes, stop - start ORDER BY doc_id, content, start) AS place FROM k
), w AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, content ORDER BY pos) AS k,
         sum(words) OVER (PARTITION BY doc_id, content ORDER BY pos) AS upto
  FROM (SELECT doc_id, content, unnest(lines) AS line, unnest(words) AS words, unnest(range(1, n + 1)) AS pos FROM h)
  WHERE words > 0
), p AS (
  SELECT a.doc_id, a.content, a.k AS head, b.k AS tail
  FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.content = b.content AND b.k > a.k AND b.k <= a.k + {RUN_WORDS}
  WHERE b.upto - a.upto + a.words > {RUN_WORDS}
    AND (b.upto - b.words - a.upto + a.words <= {RUN_WORDS} OR b.upto - a.upto <= {RUN_WORDS})
), s AS (
  SELECT doc_id, content, head, min(w.pos) AS start, max(w.pos) + 1 AS stop,
         string_agg(w.line, chr(10) ORDER BY w.pos) AS bytes
  FROM p JOIN w USING (doc_id, content) WHERE w.k BETWEEN head AND tail
  GROUP BY doc_id, content, head, tail HAVING min(w.words) < {OWN_LINE_WORDS}
), q AS (
  SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, content, start) AS place FROM s
), g AS (
  SELECT doc_id, content, unnest(range(start, stop)) AS line FROM o WHERE place > 1
  UNION SELECT doc_id, content, unnest(range(start, stop)) FROM q WHERE place > 1
), kept AS (
  SELECT doc_id, content, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM (
    SELECT doc_id, content, unnest(lines) AS line, unnest(range(1, n + 1)) AS pos FROM h) x
  WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = x.doc_id AND g.content = x.content AND g.line = x.pos)
  GROUP BY doc_id, content
)
SELECT doc_id, CAST(h.n AS BIGINT) AS n_lines, CAST(h.n - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       coalesce(kept.text, '') AS text
FROM h LEFT JOIN kept USING (doc_id, content)
"""
