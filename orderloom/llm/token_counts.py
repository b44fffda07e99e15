"""Edit-aware token counts over segment trees of pre-tokens.

Byte-level BPE merges within pre-tokens only, and a pre-token is found by scanning
forward from the end of the one before it. So an edit changes pre-tokens in a small
region: scanning restarts at the last pre-token that did not look at the edited
characters (a pre-token looks at most two characters past its end) and stops as soon as
it stands on an old boundary again. Only the pre-tokens in between are encoded anew.

A document keeps its pre-tokens in buckets, the leaves of a segment tree whose nodes sum
the characters, tokens and pre-tokens below them. An edit finds its region by descending
on characters, replaces it inside its buckets and updates the sums on their paths. A
bucket that grew too far has the tree built anew from the counts at hand.

Trees are rows: a document's text with the lengths and token counts of its pre-tokens.
``token_trees`` builds them once; ``edit_trees`` takes stored ones up again, encodes
only what the edits touch, and returns trees that can be stored in turn.

Documents are handled one by one inside tasks. Their edits come with them, grouped
by document, as an array bounded by what was edited.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import text_of
from orderloom.llm.tokens import VOCABULARY, piece_ids

#: How far past its end a pre-token's match looks: a contraction of three characters
#: after an apostrophe, or the character after the end of a white-space run.
LOOK_AHEAD = 2
BUCKET = 64
KNOWN_AT_MOST = 1 << 18
DOCS_PER_BATCH = 512


class _Counts(dict):
    """Tokens per pre-token, worked out when first asked for; emptied at a bound."""

    def __init__(self, vocabulary: str):
        self._vocabulary = vocabulary

    def __missing__(self, pre_token: str) -> int:
        if len(self) >= KNOWN_AT_MOST:
            self.clear()
        n = self[pre_token] = len(piece_ids(pre_token, self._vocabulary))
        return n

    def learn(self, pre_tokens: list[str], counts: list[int]) -> None:
        """Take over counts that are known."""
        for lo in range(0, len(pre_tokens), KNOWN_AT_MOST):
            if len(self) >= KNOWN_AT_MOST:
                self.clear()
            self.update(zip(pre_tokens[lo : lo + KNOWN_AT_MOST], counts[lo : lo + KNOWN_AT_MOST], strict=True))


@functools.cache
def _counts(vocabulary: str) -> _Counts:
    return _Counts(vocabulary)


@functools.cache
def _pattern() -> regex.Pattern:
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


class TokenTree:
    """Pre-tokens of one text with token counts, kept through edits.

    ``lengths`` and ``counts`` are those of a tree's own pre-tokens, as ``stored`` gives
    them; with these nothing is split or encoded.
    """

    def __init__(self, text: str, vocabulary: str = VOCABULARY, lengths: bytes | None = None, counts: bytes | None = None):
        self._count, self._pattern = _counts(vocabulary), _pattern()
        if lengths is None or counts is None:
            self._build(self._pattern.findall(text))
        else:
            ends = np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.int64).tolist()
            if (ends[-1] if ends else 0) != len(text):
                raise ValueError("the tree is another text's")
            pre_tokens = [text[begin:end] for begin, end in zip([0, *ends], ends, strict=False)]
            self._count.learn(pre_tokens, np.frombuffer(counts, "<u4").tolist())
            self._build(pre_tokens)
        self.encoded_chars = 0

    def stored(self) -> tuple[bytes, bytes]:
        """Lengths and token counts of all pre-tokens, as little-endian 32-bit numbers."""
        pre_tokens = [p for bucket in self.buckets for p in bucket]
        numbers = (map(len, pre_tokens), map(self._count.__getitem__, pre_tokens))
        lengths, counts = (np.fromiter(n, dtype="<u4", count=len(pre_tokens)).tobytes() for n in numbers)
        return lengths, counts

    def _build(self, pre_tokens: list[str]) -> None:
        self.buckets = [pre_tokens[i : i + BUCKET] for i in range(0, len(pre_tokens), BUCKET)] or [[]]
        self._leaves = 1 << (len(self.buckets) - 1).bit_length()
        self._sums = [(0, 0, 0)] * (2 * self._leaves)
        for at, bucket in enumerate(self.buckets, start=self._leaves):
            self._sums[at] = self._leaf(bucket)
        for at in range(self._leaves - 1, 0, -1):
            self._sum_up(at)

    def _leaf(self, bucket: list[str]) -> tuple[int, int, int]:
        return sum(map(len, bucket)), sum(map(self._count.__getitem__, bucket)), len(bucket)

    def _sum_up(self, at: int) -> None:
        (a, b, c), (d, e, f) = self._sums[2 * at], self._sums[2 * at + 1]
        self._sums[at] = (a + d, b + e, c + f)

    chars = property(lambda self: self._sums[1][0])
    tokens = property(lambda self: self._sums[1][1])
    size = property(lambda self: self._sums[1][2])

    def _bucket_at(self, char: int) -> tuple[int, int, int]:
        """The bucket that holds a character (the last one beyond the text); characters and tokens before it."""
        at, chars, tokens = 1, 0, 0
        while at < self._leaves:
            at *= 2
            if char >= chars + self._sums[at][0] and at + 1 < self._leaves * 2 and self._sums[at + 1][2]:
                chars, tokens = chars + self._sums[at][0], tokens + self._sums[at][1]
                at += 1
        return at - self._leaves, chars, tokens

    def _place(self, char: int) -> tuple[int, int, int, int]:
        """(bucket, index) of the first pre-token that ends after ``char``; characters and tokens before it."""
        b, chars, tokens = self._bucket_at(char)
        for i, pre_token in enumerate(self.buckets[b]):
            if chars + len(pre_token) > char:
                return b, i, chars, tokens
            chars, tokens = chars + len(pre_token), tokens + self._count[pre_token]
        return b, len(self.buckets[b]), chars, tokens

    def tokens_before(self, char: int) -> int:
        """Tokens of the pre-tokens that end at or before ``char``."""
        return self._place(char)[3]

    def text(self) -> str:
        return "".join(map("".join, self.buckets))

    def _from(self, bucket: int, index: int) -> Iterator[tuple[int, int, str]]:
        """Pre-tokens onward, each with the place behind it."""
        for b in range(bucket, len(self.buckets)):
            for i, pre_token in enumerate(self.buckets[b][index if b == bucket else 0 :], index if b == bucket else 0):
                yield b, i + 1, pre_token

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        """Replace ``deleted`` characters at ``start``; both are cut to the text."""
        start = min(max(start, 0), self.chars)
        end = min(start + max(deleted, 0), self.chars)
        first, index, begun, _ = self._place(start - LOOK_AHEAD) if start >= LOOK_AHEAD else (0, 0, 0, 0)
        onward = self._from(first, index)
        behind, old = (first, index), ""
        while begun + len(old) < end or not old:
            step = next(onward, None)
            if step is None:
                break
            behind, old = step[:2], old + step[2]
        text = old[: start - begun] + inserted + old[end - begun :]

        # Old boundaries in ``text``, with the places that begin there.
        boundaries = {len(text): behind}
        fresh: list[str] = []
        at, ended = 0, False
        while at not in boundaries:
            match = self._pattern.match(text, at)
            while not ended and (match is None or match.end() + LOOK_AHEAD > len(text)):
                step = next(onward, None)
                ended = step is None
                if step is not None:
                    text += step[2]
                    boundaries[len(text)] = behind = step[:2]
                    match = self._pattern.match(text, at)
            fresh.append(match[0])
            at = match.end()
        last, rest = boundaries[at]
        self.encoded_chars += at
        self._replace((first, index), (last, rest), fresh)

    def _replace(self, begin: tuple[int, int], end: tuple[int, int], fresh: list[str]) -> None:
        (first, index), (last, rest) = begin, end
        kept = self.buckets[last][rest:]
        if first == last:
            self.buckets[first] = self.buckets[first][:index] + fresh + kept
        else:
            self.buckets[first] = self.buckets[first][:index] + fresh
            self.buckets[first + 1 : last] = [[] for _ in range(first + 1, last)]
            self.buckets[last] = kept
        if len(self.buckets[first]) > 4 * BUCKET:
            self._build([p for bucket in self.buckets for p in bucket])
            return
        for b in range(first, last + 1):
            at = b + self._leaves
            self._sums[at] = self._leaf(self.buckets[b])
            while at > 1:
                at //= 2
                self._sum_up(at)


RESULT = (
    "doc_id bigint, n_edits bigint, tokens_before bigint, tokens_after bigint, pre_tokens_after bigint, "
    "chars_after bigint, encoded_chars bigint"
)


def count_after_edits(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of each row of ``docs`` before and after its edits.

    Columns doc_id, text and ``edits``, an array of (start, deleted, inserted) in code
    points, applied in order. Result: doc_id, n_edits, tokens_before, tokens_after,
    pre_tokens_after, chars_after and encoded_chars, the characters encoded anew.

    A null text is empty. Null edits are none, null fields 0 or empty. Edits beyond the
    text are cut to it. Repeated rows and null ids give rows like any other. Other
    columns are not used. An end-of-text string counts as ordinary text.
    """
    names = [c.split()[0] for c in RESULT.split(", ")]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, DOCS_PER_BATCH):
                batch, rows = whole.slice(lo, DOCS_PER_BATCH), []
                for doc_id, text, edits in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                    tree = TokenTree(text.as_py(), vocabulary)
                    before, todo = tree.tokens, [e for e in edits.as_py() or [] if e is not None]
                    for e in todo:
                        tree.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "")
                    rows.append(
                        (doc_id.as_py(), len(todo), before, tree.tokens, tree.size, tree.chars, tree.encoded_chars)
                    )
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    source = docs.select(
        F.col("doc_id").cast("bigint"),
        text_of().alias("text"),
        F.col("edits").cast("array<struct<start:bigint,deleted:bigint,inserted:string>>"),
    )
    return source.mapInArrow(run, RESULT)


TREE = "doc_id bigint, text string, n_tokens bigint, lengths binary, counts binary"
_TREE_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]


def _tree_rows(docs: DataFrame, columns: list, vocabulary: str, schema: str) -> DataFrame:
    """Trees of rows (doc_id, text, lengths, counts, edits) after their edits."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = [*_TREE_TYPES, pa.int64()][: len(names)]
    arrow = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, DOCS_PER_BATCH):
                batch, rows = whole.slice(lo, DOCS_PER_BATCH), []
                for row in zip(*batch.columns, strict=True):
                    doc_id, text, lengths, counts, edits = (value.as_py() for value in row)
                    tree = TokenTree(text, vocabulary, lengths, counts)
                    for e in edits or []:
                        if e is not None:
                            tree.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "")
                    rows.append((doc_id, tree.text(), tree.tokens, *tree.stored(), tree.encoded_chars)[: len(names)])
                found = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types, strict=True)], schema=arrow)

    return docs.select(*columns).mapInArrow(run, schema)


def token_trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """A tree per row of ``docs`` (doc_id, text): its text, token count, and the pre-tokens' lengths and counts.

    A null text is empty and has a tree without pre-tokens.
    """
    none = F.lit(None).cast("binary")
    edits = F.lit(None).cast("array<struct<start:bigint,deleted:bigint,inserted:string>>")
    columns = [F.col("doc_id").cast("bigint"), text_of().alias("text"), none.alias("lengths"), none.alias("counts"), edits.alias("edits")]
    return _tree_rows(docs, columns, vocabulary, TREE)


def edit_trees(trees: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Trees with a column ``edits`` (see ``count_after_edits``) after these, and ``encoded_chars``.

    Stored counts are taken as they are; a tree without them is built from its text.
    """
    edits = F.col("edits").cast("array<struct<start:bigint,deleted:bigint,inserted:string>>").alias("edits")
    columns = [F.col("doc_id").cast("bigint"), text_of().alias("text"), "lengths", "counts", edits]
    return _tree_rows(trees, columns, vocabulary, f"{TREE}, encoded_chars bigint")
