"""Secrets in texts: sure patterns, and weak candidates that count only beside their counterpart.

Every text is searched for parts: identifiers, secrets and endpoints, each sure or weak. An interval join over
bins as wide as the scope, on document and all places of a part, links the parts, however long they are. A weak part is reported only if a complementary
part lies within ``scope`` code points; sure ones are reported always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import stored

# The sure kinds in the order of report, with the group whose length counts and its least length.
SURE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),  # runs are maximal, so shorter ones need not be met to be dropped
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
# Runs this pattern needs: tells most texts without a match apart in one pass.
SURE_HINT = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
# Weak kinds, each with its part and the parts that complete it.
WEAK = {
    "linked_id": (r"\b(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}", "identifier", ("secret",)),
    "linked_client": (r"""\b(?i:client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9._@-]{2,}""", "identifier", ("secret",)),
    "linked_key": (r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", "secret", ("identifier",)),
    "linked_short": (r"""\b(?i:pwd|pass(?:word|wd)?|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,7}(?![A-Za-z0-9+/_.=-])""", "secret", ("identifier", "endpoint")),
}
ENDPOINT = r"""\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x00-\x20"'<>]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.amazonaws\.com\b"""
PART_OF_SURE = {"assign": "secret", "access": "identifier", "hex": "secret"}
KINDS = [*SURE, *WEAK]
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


BLOCK = 256  # array elements that one step of a fold may copy


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks_of(items: Column) -> Column:
    """An array cut into arrays of BLOCK elements. Folds that append copy a block at a time, not the whole array."""
    last = F.greatest(F.floor((F.size(items) - 1) / BLOCK).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def before_each(values: Column, add) -> Column:
    """For each long the fold of all before it, from 0."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    step = lambda state, x: F.struct(add(state["at"], x).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))
    return F.aggregate(values, begin, step, lambda state: state["out"])


def spans_of(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0, hint: str | None = None) -> Column:
    """(start, kind, end) of the leftmost non-overlapping matches whose group is long enough, in code points.

    Places follow from the lengths of the matches and of what lies between them: inside blocks of matches first, then each block
    is moved by the lengths before it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found, lambda m: F.length(m).cast("long"))
    steps = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long")).alias("gap"),
        F.transform(found, lambda m: F.length(m).cast("long")).alias("size"),
        measured.alias("measured"),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + F.coalesce(step["size"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        fits = step["size"].isNotNull() & (step["measured"] >= least)
        return F.struct(end.alias("at"), F.when(fits, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))

    def placed(folded: Column) -> Column:
        before = before_each(F.transform(folded, lambda b: b["at"]), lambda at, x: at + x)
        moved = lambda s, by: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"))
        return F.flatten(F.zip_with(folded, before, lambda b, by: F.transform(b["spans"], lambda s: moved(s, by))))

    spans = bound(F.transform(bound(steps, blocks_of), lambda block: F.aggregate(block, begin, add)), placed)
    return F.when(text.rlike(hint or pattern), spans).otherwise(F.array().cast(SPAN))


def text_key(id_column: str, text_column: str) -> list[Column]:
    """Tells documents apart where ids repeat; equal rows have equal results."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return [F.col(id_column).cast("string").alias("_id"), F.xxhash64(text).alias("_hash"), F.crc32(text.cast("binary")).alias("_crc")]


def find(documents: DataFrame, scope: int = 300, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per different (id, text): id column, _id, _hash, _crc, base (sure spans), spans (with linked ones).

    Both are arrays of (start, kind, end), by start, then kind in the order of KINDS. A null or empty text has none.
    Weak spans that overlap a sure one are left to it. Texts do not travel: only spans are stored, joined and grouped.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sure = F.array_sort(F.concat(*(spans_of(text, p, k, g, n, SURE_HINT[name]) for k, (name, (p, g, n)) in enumerate(SURE.items()))))
    weak = F.concat(*(spans_of(text, p, len(SURE) + k) for k, (p, _, _) in enumerate(WEAK.values())))
    ends = spans_of(text, ENDPOINT, len(KINDS))
    found = documents.select(F.col(id_column), *text_key(id_column, text_column), sure.alias("base"), weak.alias("weak"), ends.alias("ends"))
    found = stored(found, "parts").dropDuplicates(["_id", "_hash", "_crc"])

    parts = found.filter((F.size("weak") > 0) & (F.size("base") + F.size("weak") + F.size("ends") > 1))
    free = F.filter("weak", lambda w: ~F.exists("base", lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"])))
    part = parts.select("_id", "_hash", "_crc", F.explode(F.concat("base", free, "ends")).alias("s"))
    names = [PART_OF_SURE[k] for k in SURE] + [WEAK[k][1] for k in WEAK] + ["endpoint"]
    part = part.select("_id", "_hash", "_crc", "s", F.element_at(F.array(*map(F.lit, names)), F.col("s.kind") + 1).alias("part"))
    # All bins of a part, from its start to its end: parts at most a scope apart have bins that are equal or neighbours.
    first, last = (F.floor(F.col(f"s.{x}") / scope) for x in ("start", "end"))
    needs = F.element_at(F.array(*(F.array(*map(F.lit, WEAK[k][2])) for k in WEAK)), F.col("s.kind") - len(SURE) + 1)
    asks = part.filter((F.col("s.kind") >= len(SURE)) & (F.col("s.kind") < len(KINDS))).select("_id", "_hash", "_crc", "s", F.explode(needs).alias("need"))
    asks = asks.withColumn("near", F.explode(F.sequence(first - 1, last + 1)))
    there = part.select(F.col("_id").alias("i"), F.col("_hash").alias("h"), F.col("_crc").alias("c"), F.col("s").alias("o"), "part", F.explode(F.sequence(first, last)).alias("b"))
    gap = F.greatest(F.col("o.start") - F.col("s.end"), F.col("s.start") - F.col("o.end"))
    near = F.col("_id").eqNullSafe(F.col("i")) & (F.col("_hash") == F.col("h")) & (F.col("_crc") == F.col("c")) & (F.col("near") == F.col("b")) & (F.col("need") == F.col("part"))
    linked = asks.join(there, near & (gap <= scope) & (F.col("o") != F.col("s")), "left_semi")
    linked = linked.groupBy("_id", "_hash", "_crc").agg(F.collect_set("s").alias("linked"))
    linked = linked.select(F.col("_id").alias("i"), F.col("_hash").alias("h"), F.col("_crc").alias("c"), "linked")
    same = F.col("_id").eqNullSafe(F.col("i")) & (F.col("_hash") == F.col("h")) & (F.col("_crc") == F.col("c"))
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(SPAN))))
    return found.join(linked, same, "left").select(id_column, "_id", "_hash", "_crc", "base", every.alias("spans"))


def per_document(documents: DataFrame, scope: int = 300, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The given columns with base and spans of every row, repeated rows included."""
    found = find(documents, scope, id_column, text_column).select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.col("_crc").alias("_c"), "base", "spans")
    keyed = documents.drop("base", "spans").select("*", *text_key(id_column, text_column))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")) & (F.col("_crc") == F.col("_c"))
    return keyed.join(found, same).drop("_id", "_hash", "_crc", "_i", "_h", "_c")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans (sorted by start) replaced by the mark.

    Spans are taken in blocks; each block cuts its own part of the text, from where the blocks before it end.
    """

    def cut(own: Column, block: Column, first: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            between = F.substr(own, (state["at"] - first + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
            apart = s["start"] >= state["at"]
            return F.struct(
                F.greatest(state["at"], s["end"]).alias("at"),
                F.when(apart, F.concat(state["out"], F.array(between, F.lit(mark)))).otherwise(state["out"]).alias("out"),
            )

        begin = F.struct(first.alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(block, begin, step, lambda state: F.array_join(state["out"], ""))

    def part(block: Column, first: Column) -> Column:
        end = F.greatest(first, F.array_max(F.transform(block, lambda s: s["end"])))
        return bound(F.substr(text, (first + 1).cast("int"), (end - first).cast("int")), lambda own: cut(own, block, first))

    def whole(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda block: F.array_max(F.transform(block, lambda s: s["end"])))
        return F.array_join(F.zip_with(blocks, before_each(ends, F.greatest), part), "")

    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    rest = F.substr(text, (end + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(bound(blocks_of(spans), whole), rest)).otherwise(text)
