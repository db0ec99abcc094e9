"""Token counts that follow edits.

A document is kept as a tree over its pre-tokens: leaves hold the length and token count of each
pre-token, blocks of leaves and the nodes above them hold sums. An edit pre-tokenises anew from
just before the text it touches (the boundary context) until a boundary falls on an old one past the
edit; from there on the old leaves hold, since a match of the pattern looks only ahead. Only the
new pre-tokens are encoded, and only the sums above the touched blocks are changed.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sliced, trim, without

#: The public byte-level pattern: contractions, letters, numbers, other signs, white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Code points past its end that may decide a match, leaves of a block, and pre-tokens that a worker remembers.
AHEAD, LEAVES, REMEMBERED = 4, 256, 300_000


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Counter:
    """Token counts of pre-tokens, remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.pattern = regex.compile(pattern)
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}
        self.encoded = 0

    def counts(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for p in pieces:
            n = known.get(p)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[p] = len(self.encode(p))
            out.append(n)
        return out


class TokenTree:
    """A text with its pre-tokens' lengths and counts in blocks, and a binary tree of sums over the blocks."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        pieces = counter.pattern.findall(text)
        self.reencoded = 0
        self._place([len(p) for p in pieces], counter.counts(pieces))

    def _place(self, lengths: list[int], counts: list[int]) -> None:
        cut = range(0, max(1, len(lengths)), LEAVES)
        self.blocks = [(lengths[i : i + LEAVES], counts[i : i + LEAVES]) for i in cut]
        self._build()

    def _build(self) -> None:
        self.width = 1 << (len(self.blocks) - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.width)
        for i, (lengths, counts) in enumerate(self.blocks):
            self.sums[self.width + i] = (sum(lengths), sum(counts))
        for i in range(self.width - 1, 0, -1):
            self._add(i)

    def _add(self, i: int) -> None:
        (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = (a + c, b + d)

    @property
    def total(self) -> int:
        return self.sums[1][1]

    def _find(self, at: int) -> tuple[int, int, int]:
        """Block, leaf and begin of the pre-token that holds position ``at``; of the last one, if there is none."""
        i, begin = 1, 0
        while i < self.width:
            left = self.sums[2 * i][0]
            i, begin = (2 * i, begin) if at < begin + left else (2 * i + 1, begin + left)
        block = min(i - self.width, len(self.blocks) - 1)
        if i - self.width != block:
            begin = self.sums[1][0] - sum(self.blocks[block][0])
        lengths, leaf = self.blocks[block][0], 0
        while leaf + 1 < len(lengths) and begin + lengths[leaf] <= at:
            begin += lengths[leaf]
            leaf += 1
        return block, leaf, begin

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace ``text[start:end]`` by ``new``; positions beyond the text count as its end."""
        start, end = min(start, len(self.text)), min(max(start, end), len(self.text))
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        block, leaf, begin = self._find(max(0, start - AHEAD))
        # old leaves in order from here on, as far as they are needed
        b, i, old = block, leaf, begin
        pieces: list[str] = []
        at, settled = begin, False
        while at < len(text):
            # a new boundary past the edit that is an old one too
            while old + shift < at or old < end:
                if b >= len(self.blocks) or (i >= len(self.blocks[b][0]) and b + 1 >= len(self.blocks)):
                    break
                if i >= len(self.blocks[b][0]):
                    b, i = b + 1, 0
                    continue
                old += self.blocks[b][0][i]
                i += 1
            if old >= end and old + shift == at and at >= start + len(new):
                settled = True
                break
            piece = self.counter.pattern.match(text, at).group()
            pieces.append(piece)
            at += len(piece)
        if not settled:
            b, i = len(self.blocks) - 1, len(self.blocks[-1][0])
        self.text = text
        self.reencoded += len(pieces)
        head, tail = self.blocks[block], self.blocks[b]
        lengths = head[0][:leaf] + [len(p) for p in pieces] + tail[0][i:]
        counts = head[1][:leaf] + self.counter.counts(pieces) + tail[1][i:]
        if b == block and len(lengths) <= 2 * LEAVES and (lengths or len(self.blocks) == 1):
            self.blocks[block] = (lengths, counts)
            j = self.width + block
            self.sums[j] = (sum(lengths), sum(counts))
            while j > 1:
                j //= 2
                self._add(j)
            return
        self.blocks[block : b + 1] = [(lengths[k : k + LEAVES], counts[k : k + LEAVES]) for k in range(0, len(lengths), LEAVES)]
        self.blocks = self.blocks or [([], [])]
        self._build()


def sample_edits(text: str) -> list[tuple[int, int, str]]:
    """Three edits that any text has: a passage replaced, words put in, and a passage cut; each after the one before."""
    n = len(text)
    return [(n // 3, n // 3 + 20, text[:20][::-1]), (n // 2, n // 2, " edited 2024 "), (2 * n // 3, 2 * n // 3 + 10, "")]


def counted(docs: DataFrame, ranks: dict[bytes, int], edits=sample_edits, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_tokens_edited, n_pretokens, n_reencoded of the whole text and its edits.

    ``edits(text)`` lists (start, end, new text) in code points, each of the text as edited so far.
    ``n_reencoded``: pre-tokens looked at again for all edits. ``pattern`` may look no more than AHEAD code
    points past the end of a match, as the public ones do. A null text counts as empty, and its edits
    are made as those of an empty one; repeated rows come out alike, very long texts are read whole, an
    empty table gives an empty one. Columns of these names are replaced.
    """
    base = without(docs, "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded")
    names = [*base.columns, "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded"]
    at = names.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary file, whatever the corpus

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value, pattern)
        for batch in sliced(batches, at):
            out: list[list[int]] = [[], [], [], []]
            for x in batch.column(at):
                whole = x.as_py() or ""
                tree = TokenTree(whole, counter)
                before, pieces = tree.total, sum(len(b[0]) for b in tree.blocks)
                for edit in edits(whole):
                    tree.edit(*edit)
                for into, value in zip(out, (before, tree.total, pieces, tree.reencoded)):
                    into.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in out)], names=names)
        trim()

    return base.mapInArrow(step, base.withColumns({n: F.lit(0).cast("long") for n in names[-4:]}).schema)


def op5_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_pretokens, n_reencoded) of every document and three edits of it."""
    return counted(read(spark, sf_dir, "documents").select("doc_id", "text"), ranks_of(vocabulary)).select("doc_id", "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded")
