"""Secret scans with multipart credential linking.

Three base patterns report by themselves: key-value assignments, access
identifiers and long hexadecimal strings. Weaker parts are worth reporting only
together: an identifier, a secret-looking token and an endpoint form a credential where
they begin within one scope, an interval of ``SCOPE`` code points wherever it lies. Base
access identifiers count as identifiers, other base spans as secrets. A weak part is
reported if it begins in a scope that holds all three.

The interval join runs inside a document, over its parts in order. One pass backward
finds, for each part, the next one of every kind; a scope that begins at the part is
complete if the farthest of them lies in it. One pass forward hands each part the last
complete scope begun before it. Both are linear, as are the running sums that turn
lengths into positions: arrays grow by blocks, never by one element at a time. Nothing
is shuffled and no pairs are built, so one document is the largest unit of work.

Positions come from splitting a text at the matches of a pattern: a match begins
after the pieces and matches before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import text_of

SCOPE = 400
#: Elements that a running state is handed through at once.
BLOCK = 256
#: Code points of a piece in which a text is cut to take out ranges.
PIECE = 4096
REDACTED = "[REDACTED]"

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6

# Weak parts.
WEAK_ID = (
    r"AKIA[A-Z0-9]{8,15}(?![A-Z0-9])"
    r"|(?:client_id|access_key|user(?:name)?|login|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
)
WEAK_SECRET = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[A-Z])"
    r"[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])"
)
ENDPOINT = r"[a-z][a-z0-9+]{1,9}://[A-Za-z0-9.-]+(?::[0-9]+)?|(?:host|endpoint|server)\x20*[:=]\x20*[A-Za-z0-9.-]{4,}"

#: Kinds in the order in which spans at one start are listed.
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret")

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, also where lambdas in the body use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _states(items: Column, begin: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state after each of ``items``, from ``begin`` on by ``step(state, item)``.

    States are collected per block, and blocks into their array, so what is copied grows
    with a block's size and the number of blocks, not with the square of the items.
    """
    last = lambda states: F.element_at(states, -1)

    def through(states: Column, block: Column) -> Column:
        within = F.aggregate(block, F.array(last(last(states))), lambda a, item: F.concat(a, F.array(step(last(a), item))))
        return F.concat(states, F.array(within))

    def of(items: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(items) - 1) / F.lit(BLOCK)).cast("int")),
            lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)),
        )
        found = F.aggregate(blocks, F.array(F.array(begin)), through)
        # Every block begins with the state before it, and all blocks with the first state.
        after = F.flatten(F.transform(found, lambda states: F.slice(states, 2, F.size(states))))
        return F.when(F.size(items) > 0, after).otherwise(F.slice(F.array(begin), 1, 0))

    return _let(items, of)


def _spans(text: Column, matches: Column, pattern: str, kind: str) -> Column:
    """Spans of ``matches``, all matches of ``pattern`` in ``text``, in code points."""
    rank = F.lit(KINDS.index(kind))

    def span(end: Column, hit: Column) -> Column:
        start = end - F.length(hit)
        return F.struct(start.alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))

    def of(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
        lengths = F.zip_with(gaps, hits, lambda gap, hit: (F.length(gap) + F.length(hit)).cast("bigint"))
        ends = _states(lengths, F.lit(0).cast("bigint"), lambda at, length: at + length)
        return F.when(F.size(hits) > 0, F.zip_with(ends, hits, span)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return _let(matches, of)


def _all(pattern: str, text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


#: A part's kind in a credential.
IDENTIFIER, SECRET, ENDPOINT_PART = 0, 1, 2
_NEXT = "struct<p0:bigint,p1:bigint,p2:bigint>"
_KEY_BITS = 32
PARTS = "array<struct<start:bigint,part:int,end:bigint,weak:boolean>>"


def _parts(spans: Column, part: int, weak: bool) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(part).alias("part"), s["end"].alias("end"), F.lit(weak).alias("weak"))
    )


def _linked(items: Column) -> Column:
    """The weak ones of ``items``, parts in order, that begin in a scope which holds all kinds."""

    def nearer(state: Column, item: Column) -> Column:
        return F.struct(
            *[F.when(item["part"] == p, item["start"]).otherwise(state[f"p{p}"]).alias(f"p{p}") for p in range(3)]
        )

    onward = F.reverse(_states(F.reverse(items), F.lit(None).cast(_NEXT), nearer))
    begins = F.zip_with(
        items,
        onward,
        lambda item, after: F.when(
            after["p0"].isNotNull()
            & after["p1"].isNotNull()
            & after["p2"].isNotNull()
            & (F.greatest(after["p0"], after["p1"], after["p2"]) - item["start"] <= SCOPE),
            item["start"],
        ),
    )
    last = _states(begins, F.lit(None).cast("bigint"), lambda state, begin: F.coalesce(begin, state))
    judged = F.zip_with(
        items, last, lambda item, scope: F.struct(item.alias("item"), (item["weak"] & (item["start"] - scope <= SCOPE)).alias("in"))
    )
    return F.transform(F.filter(judged, lambda j: F.coalesce(j["in"], F.lit(False))), lambda j: j["item"])


def _spans_of(linked: Column, part: int, kind: str, base: Column) -> Column:
    """Linked parts of one kind as spans, without those that are base spans too."""
    key = lambda s: F.shiftleft(s["start"], _KEY_BITS) + (s["end"] - s["start"])
    fresh = F.array_except(F.transform(F.filter(linked, lambda item: item["part"] == part), key), F.transform(base, key))
    start = lambda k: F.shiftright(k, _KEY_BITS)
    return F.transform(
        fresh,
        lambda k: F.struct(
            start(k).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            (start(k) + k.bitwiseAND(F.lit((1 << _KEY_BITS) - 1))).alias("end"),
        ),
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``doc`` with ``base`` and ``linked``, arrays of spans.

    A span has start and end (code points, end exclusive) and its kind; arrays are
    sorted by start, then kind. A null text has none. Every row is handled by itself:
    null ids, repeated rows and other columns of any name pass through. A linked span
    never repeats a base span.
    """
    text = F.col("_text")
    none = F.array().cast("array<string>")
    found = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_of().alias("_text"))
        .withColumn("_assign", _all(ASSIGN, text))
        .withColumn("_access", F.when(text.contains("AKIA"), _all(ACCESS, text)).otherwise(none))
        .withColumn("_hex", _all(HEX, text))
        .withColumn(
            "_endpoint",
            F.when(text.contains("://") | text.rlike("host|endpoint|server"), _all(ENDPOINT, text)).otherwise(none),
        )
    )
    assign = _spans(text, F.col("_assign"), ASSIGN, "assign")
    long_enough = F.transform("_assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_MIN)
    kept = F.transform(
        F.filter(F.arrays_zip(assign.alias("span"), long_enough.alias("ok")), lambda p: p["ok"]), lambda p: p["span"]
    )
    based = found.withColumn(
        "base",
        F.array_sort(
            F.concat(
                F.when(F.size("_assign") > 0, kept).otherwise(F.array().cast(f"array<{SPAN}>")),
                _spans(text, F.col("_access"), ACCESS, "access"),
                _spans(text, F.col("_hex"), HEX, "hex"),
            )
        ),
    ).withColumn("_may_link", F.size("_endpoint") > 0)

    ids = _spans(text, _all(WEAK_ID, text), WEAK_ID, "linked_id")
    secrets = _spans(text, _all(WEAK_SECRET, text), WEAK_SECRET, "linked_secret")
    empty = F.array().cast(f"array<{SPAN}>")
    parts = (
        based.withColumn("_ids", F.when(F.col("_may_link"), ids).otherwise(empty))
        .withColumn("_secrets", F.when(F.col("_may_link") , secrets).otherwise(empty))
        .withColumn(
            "_places",
            F.when(F.col("_may_link"), _spans(text, F.col("_endpoint"), ENDPOINT, "linked_id")).otherwise(empty),
        )
    )
    strong_ids = F.filter("base", lambda s: s["kind"] == "access")
    strong_secrets = F.filter("base", lambda s: s["kind"] != "access")
    ordered = F.array_sort(
        F.concat(
            _parts(F.col("_ids"), IDENTIFIER, True),
            _parts(F.col("_secrets"), SECRET, True),
            _parts(strong_ids, IDENTIFIER, False),
            _parts(strong_secrets, SECRET, False),
            _parts(F.col("_places"), ENDPOINT_PART, False),
        )
    )
    found = parts.withColumn("_parts", F.when(F.col("_may_link"), ordered)).withColumn(
        "_linked", F.when(F.size(F.coalesce(F.col("_parts"), F.array().cast(PARTS))) > 2, _linked(F.col("_parts")))
    )
    spans = F.concat(
        _spans_of(F.col("_linked"), IDENTIFIER, "linked_id", F.col("base")),
        _spans_of(F.col("_linked"), SECRET, "linked_secret", F.col("base")),
    )
    return found.select("doc", "base", F.when(F.size("_linked") > 0, F.array_sort(spans)).otherwise(empty).alias("linked"))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans(base: str = "base", linked: str = "linked") -> Column:
    return F.array_sort(F.concat(F.col(base), F.col(linked)))


def _range(pieces: Column, begin: Column, length: Column) -> Column:
    """``length`` code points from ``begin`` (from 0) of a text cut in pieces of ``PIECE``."""
    first, last = F.floor(begin / F.lit(PIECE)), F.floor((begin + length) / F.lit(PIECE))
    joined = F.array_join(F.slice(pieces, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    return joined.substr((begin - first * PIECE + 1).cast("int"), length.cast("int"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced; overlapping spans become one."""
    zero = F.lit(0).cast("bigint")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def of(pieces: Column, ends: Column) -> Column:
        # Each span with the end of what comes before it; it is new if it begins there or later.
        before = F.slice(F.concat(F.array(zero), ends), 1, F.size(ends))
        kept = lambda at, span: F.when(
            span["start"] >= at, F.concat(_range(pieces, at, span["start"] - at), F.lit(REDACTED))
        ).otherwise(F.lit(""))
        end = F.element_at(ends, -1)
        return F.concat(F.array_join(F.zip_with(before, spans, kept), ""), _range(pieces, end, F.length(text) - end))

    ends = _states(spans, zero, lambda end, span: F.greatest(end, span["end"]))
    clean = _let(pieces, lambda pieces: _let(ends, lambda ends: of(pieces, ends)))
    return F.when(F.size(spans) > 0, clean).otherwise(text)


def redacted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` in its own columns with secrets replaced in the text.

    ``n_chars`` follows the new text where it was changed. A null text stays null.
    """
    spans = find_secrets(docs).select("doc", all_spans().alias("spans"))
    clean = F.when(F.size("spans") > 0, redacted(F.col("doc.text"), F.col("spans"))).otherwise(F.col("doc.text"))
    changed = spans.withColumn("_clean", clean)
    columns = {
        "text": F.col("_clean"),
        "n_chars": F.when(F.size("spans") > 0, F.length("_clean").cast("bigint")).otherwise(F.col("doc.n_chars"))
        if "n_chars" in docs.columns
        else None,
    }
    return changed.select(
        *[columns[c].alias(c) if columns.get(c) is not None else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )
