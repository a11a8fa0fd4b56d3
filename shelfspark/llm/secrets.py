"""Secret scans: pattern kinds plus sliding-window Shannon entropy, in DataFrame functions only.

Base kinds are leftmost non-overlapping matches of three patterns, failing matches dropped.
The method adds spans of kind ``entropy``: candidate strings are runs of token characters of at
least ``SHORTEST`` characters; each belongs to a character class (hexadecimal or mixed), and a
window of ``WINDOW`` characters slides over it. ``sum(c * log2(c))`` over the window's character
counts is kept incrementally: one character leaves and one enters per step. Windows whose
entropy reaches the threshold of their class make a span, from the first to the last of them.
Base spans are cut out of the candidates; the pieces of at least ``SHORTEST`` characters that
are left are candidates like any other. Candidates that match the allow-list add none.

Positions are code points, ends exclusive. Defined cases: null text is empty and has no spans;
an empty span list hashes the empty string; texts and candidates of any length are scanned
whole, in blocks; rows are independent, so repeated rows, null ids and extra columns do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.common import read
from shelfspark.llm.quality import let

# The base patterns, their kinds in order, and how long a match must be.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

SHORTEST, WINDOW, BLOCK = 20, 20, 512
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Bits per character from which a window counts, by class of its candidate.
LEAST_BITS = {"hex": 3.0, "mixed": 3.8}
# Candidates that are no secrets: plain words, paths of words, numbers, UUIDs, runs of one character.
ALLOWED = (r"^[A-Za-z_/=+-]*$", r"^[0-9_/=+-]*$",
           r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^(.)\1*$")
SCALE = 10 ** 9

SPAN = "array<struct<start: int, end: int, kind: int>>"


def _spans(text: Column, pattern: str, kind: int, least: int, group: int = 0, has: Column | None = None) -> Column:
    """Spans of the matches whose group has at least ``least`` characters.

    The text is split at the matches: the pieces between them give the positions.
    """
    def place(pieces: Column, whole: Column, sized: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

        def add(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(pieces, i))
            end = begin + F.length(F.get(whole, i))
            span = F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind")))
            return F.struct(end.alias("at"), F.when(
                F.length(F.get(sized, i)) >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(whole) - 1), start, add, lambda acc: acc["out"])

    found = F.struct(F.split(text, pattern, -1).alias("pieces"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("sized"))
    spans = let(found, lambda x: F.when(F.size(x["whole"]) > 0, place(x["pieces"], x["whole"], x["sized"]))
                .otherwise(F.array().cast(SPAN)))
    return spans if has is None else F.when(has, spans).otherwise(F.array().cast(SPAN))


def _weight(count: int) -> int:
    return round(count * math.log2(count) * SCALE) if count else 0


def _loud(candidate: Column) -> Column:
    """First start and last end of the windows of a candidate that reach its class's threshold."""
    weights = F.array(*[F.lit(_weight(k)) for k in range(WINDOW + 2)])

    def weight(k: Column) -> Column:
        return F.get(weights, k)

    def count(window: Column, c: Column) -> Column:
        return F.length(window) - F.length(F.replace(window, c, F.lit("")))

    def most(bits: float) -> int:  # sum(c * log2(c)) that still reaches the threshold
        return math.floor((math.log2(WINDOW) - bits) * WINDOW * SCALE)

    limit = F.when(candidate.rlike(r"^[0-9a-fA-F]+$"), F.lit(most(LEAST_BITS["hex"]))).otherwise(
        F.lit(most(LEAST_BITS["mixed"])))

    def block(offset: Column) -> Column:
        """Windows that start in [offset, offset + BLOCK)."""
        def scan(piece: Column, most_weight: Column) -> Column:
            first = F.substring(piece, 1, WINDOW)
            total = F.aggregate(
                F.array_distinct(F.split(first, "")), F.lit(0).cast("long"),
                lambda acc, c: acc + F.when(c != "", weight(count(first, c))).otherwise(0))
            none = F.lit(None).cast("int")
            start = F.struct(total.alias("total"),
                             F.when(total <= most_weight, 0).otherwise(none).alias("first"),
                             F.when(total <= most_weight, 0).otherwise(none).alias("last"))

            def slide(acc: Column, i: Column) -> Column:
                out = F.substring(piece, i, 1)
                into = F.substring(piece, i + WINDOW, F.lit(1))
                k_out = count(F.substring(piece, i, WINDOW), out)
                k_in = count(F.substring(piece, i + 1, F.lit(WINDOW - 1)), into)
                now = (acc["total"] - weight(k_out) + weight(k_out - 1) + weight(k_in + 1) - weight(k_in))
                return let(now, lambda t: F.struct(
                    t.alias("total"),
                    F.when(t <= most_weight, F.coalesce(acc["first"], i)).otherwise(acc["first"]).alias("first"),
                    F.when(t <= most_weight, i).otherwise(acc["last"]).alias("last")))

            steps = F.length(piece) - WINDOW
            js = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
            return F.aggregate(js, start, slide, lambda acc: F.struct(
                (acc["first"] + offset).alias("first"), (acc["last"] + offset + WINDOW).alias("last")))

        return let(F.struct(F.substring(candidate, offset + 1, F.lit(BLOCK + WINDOW - 1)).alias("piece"),
                            limit.alias("limit")), lambda x: scan(x["piece"], x["limit"]))

    blocks = F.transform(F.sequence(F.lit(0), F.length(candidate) - WINDOW, F.lit(BLOCK)), block)
    return let(blocks, lambda b: F.struct(
        F.array_min(F.transform(b, lambda x: x["first"])).alias("first"),
        F.array_max(F.transform(b, lambda x: x["last"])).alias("last")))


def _entropy_spans(text: Column, base: Column) -> Column:
    spans = _spans(text, CANDIDATE, KINDS.index("entropy"), SHORTEST)

    def allowed(s: Column) -> Column:
        hit = F.lit(False)
        for pattern in ALLOWED:
            hit = hit | s.rlike(pattern)
        return hit

    def narrowed(span: Column) -> Column:
        piece = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        return let(piece, lambda s: F.when(~allowed(s), let(_loud(s), lambda x: F.when(
            x["first"].isNotNull(), F.struct(
                (span["start"] + x["first"]).alias("start"), (span["start"] + x["last"]).alias("end"),
                span["kind"].alias("kind"))))))

    def piece(start: Column, end: Column, kind: Column) -> Column:
        return F.when(end - start >= SHORTEST, F.array(F.struct(
            start.alias("start"), end.alias("end"), kind.alias("kind")))).otherwise(F.array().cast(SPAN))

    def pieces(s: Column) -> Column:
        """What the base spans leave of a candidate."""
        start = F.struct(s["start"].alias("at"), F.array().cast(SPAN).alias("out"))
        met = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return let(met, lambda found: F.when(F.size(found) == 0, F.array(s)).otherwise(F.aggregate(
            F.array_sort(found), start,
            lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"),
                                    F.concat(acc["out"], piece(acc["at"], b["start"], s["kind"])).alias("out")),
            lambda acc: F.concat(acc["out"], piece(acc["at"], s["end"], s["kind"])))))

    free = F.flatten(F.transform(spans, pieces))
    return F.when(text.rlike(CANDIDATE), F.array_compact(F.transform(free, narrowed))).otherwise(F.array().cast(SPAN))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """Per input row: id, ``base`` and ``added`` spans (start, end, kind number); if asked for the row as ``_row``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = F.lower(text)
    worded = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "api"):
        worded = worded | F.contains(low, F.lit(word))
    more = [F.struct(*[F.col(c) for c in docs.columns]).alias("_row")] if keep_row else []
    rows = docs.select(
        F.col(id_col), *more, text.alias("_text"),
        F.concat(_spans(text, ASSIGN, 0, LEAST_VALUE, 2, worded),
                 _spans(text, ACCESS, 1, LEAST_ACCESS, 0, F.contains(text, F.lit("AKIA"))),
                 _spans(text, HEX, 2, LEAST_HEX, 0, text.rlike("[0-9a-f]{%d}" % LEAST_HEX))).alias("base"))
    return rows.withColumn("added", _entropy_spans(F.col("_text"), F.col("base")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The input with every span replaced by ``mark``; texts without spans stay as they are."""
    spans = F.array_sort(F.concat("base", "added"))

    def cut(all_spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def add(acc: Column, s: Column) -> Column:
            gap = F.when(s["start"] >= acc["at"], F.concat(
                F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

        return F.aggregate(all_spans, start, add, lambda acc: F.concat(
            acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.length("_text"))))

    clean = F.when(F.size(F.concat("base", "added")) > 0, cut(spans)).otherwise(F.col("_row")[text_col])
    return scan(docs, id_col, text_col, keep_row=True).select(
        *[clean.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"))
