"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end the prefix's
encoding: the candidate whose pair with the last token of the shorter prefix re-merges to
itself.  ``last_tokens`` stores that token for each prefix, so an encoding is read off by
walking back, an append only adds entries, and an edit recomputes the entries behind it
(``append_text`` and
``edit_text`` do so between the nearest safe cuts of a whole text).

Defined cases: a null text encodes as the empty text (no ids); null ids decode to empty
bytes; texts of any length are processed whole, in blocks cut where no piece can cross;
an unknown id raises.  All other columns pass through untouched, so repeated rows, nulls
elsewhere and extra columns have no effect; an output name that exists raises.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import LONE_SPACE, file_bytes, safe_blocks, table

CACHED = 120_000        # stretches whose ids a worker keeps in each of two generations
CACHED_PREFIXES = 150_000  # byte prefixes whose last token it keeps, likewise
CACHED_PAIRS = 200_000  # pair verdicts it keeps at most
CACHED_BYTES = 64       # longer stretches and pieces are not kept


class Recent(dict):
    """A bounded cache: entries unused for a whole generation are forgotten."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHED_BYTES:
            if len(self) >= self.most:
                self.older.clear()      # before the copy, which would else be a third generation
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary and the prefix dynamic program over them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.packed = {t: r.to_bytes(4, "little") for t, r in ranks.items()}
        self.findall = regex.compile(pattern).findall
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.made: dict[bytes, tuple[bytes, ...] | None] = {}
        self.prefixes = Recent(self._last, CACHED_PREFIXES)
        self.after_space = Recent(lambda s: self._stretch(" " + s), CACHED)

    @functools.cached_property
    def suffixes(self) -> dict[bytes, bool]:
        """Every suffix of a token, and whether it is a token itself."""
        return {t[i:]: False for t in self.ranks for i in range(1, len(t))} | dict.fromkeys(self.ranks, True)

    def halves(self, token: bytes) -> tuple[bytes, ...] | None:
        """The two tokens whose merge makes a token; () for a byte, None if merges never make it."""
        if token not in self.made:
            parts = [token[i:i + 1] for i in range(len(token))]
            while len(parts) > 2:
                found = [(r, i) for i in range(len(parts) - 1)
                         if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
                if not found:
                    break
                _, i = min(found)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.made[token] = () if len(token) == 1 else tuple(parts) if len(parts) == 2 else None
        return self.made[token]

    def fits(self, left: bytes, right: bytes) -> bool:
        """Do two neighbouring tokens (left may be empty) survive the merges as they are?

        Undo the merges next to the border, latest first: at no time may the two tokens
        that then met have been able to merge before the merge just undone."""
        key = (left, right)
        verdict = self.pairs.get(key)
        if verdict is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            verdict = self.pairs[key] = self._fits(left, right)
        return verdict

    def _fits(self, left: bytes, right: bytes) -> bool:
        if self.halves(right) is None:
            return False
        if not left:
            return True
        rank, before = self.ranks, len(self.ranks) << 1
        while True:
            met = rank.get(left + right)
            if met is not None and met < before:
                return False
            lefts, rights = self.halves(left), self.halves(right)
            if lefts and (not rights or rank[left] > rank[right]):
                left, before = lefts[1], rank[left]
            elif rights:
                right, before = rights[0], rank[right] + 1  # of equal merges the left one comes first
            else:
                return True

    def candidates(self, data: bytes, end: int) -> list[bytes]:
        """The tokens that ``data[:end]`` ends with, longest first."""
        start, found, suffixes = end - 1, [], self.suffixes
        while start >= 0 and (kind := suffixes.get(tail := data[start:end])) is not None:
            if kind:
                found.append(tail)
            start -= 1
        found.reverse()
        return found

    def _last(self, prefix: bytes) -> bytes:
        """The token that ends the encoding of a short prefix; ``prefixes`` stores it."""
        suffixes, prefixes, pairs = self.suffixes, self.prefixes, self.pairs
        start = end = len(prefix)
        while start and prefix[start - 1:] in suffixes:     # the longest suffix of a token that ends here
            start -= 1
        while start < end:
            token = prefix[start:]
            if suffixes[token]:
                left = prefixes[prefix[:start]] if start else b""
                verdict = pairs.get((left, token))
                if self.fits(left, token) if verdict is None else verdict:
                    return token
            start += 1
        raise ValueError("the vocabulary cannot encode a byte")

    def last_tokens(self, data: bytes, last: list[bytes] | None = None) -> list[bytes]:
        """``last[i]``: the token that ends the encoding of ``data[:i]`` (``last[0]`` is empty).
        Entries given in ``last`` are kept, so an append computes only those of its own bytes."""
        last = list(last) if last else [b""]
        for end in range(len(last), len(data) + 1):
            for token in self.candidates(data, end):
                if self.fits(last[end - len(token)], token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary cannot encode a byte")
        return last

    def _piece(self, piece: str) -> bytes:
        """Packed ids of one match of the pattern, read off backwards from the last tokens."""
        data, packed = piece.encode("utf-8", "surrogatepass"), self.packed
        whole = packed.get(data)
        if whole is not None:
            return whole
        found, end = [], len(data)
        last, prefixes = self.last_tokens(data) if end > CACHED_BYTES else None, self.prefixes
        while end:
            token = last[end] if last else prefixes[data[:end]]
            found.append(packed[token])
            end -= len(token)
        found.reverse()
        return b"".join(found)

    def _stretch(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.findall(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text.  A space between two characters that are not white space
        always starts a piece, so the stretches between such spaces are encoded (and
        remembered) one by one."""
        packed = []
        for block in safe_blocks(text):
            first, *rest = LONE_SPACE.split(block)
            packed += [self._stretch(first), *map(self.after_space.__getitem__, rest)]
        return np.frombuffer(b"".join(packed), "<i4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def append_text(self, text: str, ids: list[int], tail: str) -> list[int]:
        """Ids of ``text + tail``, re-encoding only from the last safe cut of ``text``."""
        return self.edit_text(text, ids, len(text), 0, tail)

    def edit_text(self, text: str, ids: list[int], at: int, removed: int, inserted: str) -> list[int]:
        """Ids after replacing ``removed`` characters at ``at``: only the stretch between
        the safe cuts around the edit is encoded anew."""
        start = _cut_before(text, at)
        end = _cut_after(text, at + removed)
        head, tail_at = self._split(ids, len(text[:start].encode())), len(text[:end].encode())
        middle = self.encode(text[start:at] + inserted + text[at + removed:end])
        return [*ids[:head], *middle, *ids[self._split(ids, tail_at):]]

    def _split(self, ids, size: int) -> int:
        """How many tokens make up the first ``size`` bytes."""
        n = 0
        for i, t in enumerate(ids):
            if n >= size:
                return i
            n += len(self.tokens[t])
        return len(ids)


def _is_cut(text: str, i: int) -> bool:
    return (0 < i < len(text) - 1 and text[i] == " " and "a" <= text[i - 1] <= "z" and "a" <= text[i + 1] <= "z")


def _cut_before(text: str, at: int) -> int:
    """The last safe cut that lies wholly before ``at``."""
    i = at - 2
    while i > 0 and not _is_cut(text, i):
        i -= 1
    return max(i, 0)


def _cut_after(text: str, at: int) -> int:
    i = at + 1
    while i < len(text) and not _is_cut(text, i):
        i += 1
    return min(i, len(text))


@functools.lru_cache(maxsize=2)
def vocabulary(ranks_file: bytes, pattern: str) -> Vocabulary:
    rows = (line.split() for line in ranks_file.splitlines() if line)
    return Vocabulary({base64.b64decode(a): int(b) for a, b in rows}, pattern)


def _fresh(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {name}")


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column as an array of ints."""
    _fresh(df, ids)
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(shared.value, pattern)
        for batch in batches:
            found = [vocab.encode(value.as_py() or "") for value in batch]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *found])))

    return df.withColumn(ids, ids_of(F.col(text)))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add the bytes that an array of token ids stands for."""
    _fresh(df, data)
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(shared.value, pattern)
        for batch in batches:
            yield pa.array([vocab.decode(v.values.to_numpy().tolist() if v.is_valid else ()) for v in batch], pa.binary())

    return df.withColumn(data, bytes_of(F.col(ids)))


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
               data: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one worker a task: two would each hold the vocabulary."""
    _fresh(df, ids)
    _fresh(df, data)
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    @F.arrow_udf(f"struct<{ids}: array<int>, {data}: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(shared.value, pattern)
        for batch in batches:
            found = [vocab.encode(value.as_py() or "") for value in batch]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *found])))
            decoded = pa.array([vocab.decode(x.tolist()) for x in found], pa.binary())
            yield pa.StructArray.from_arrays([lists, decoded], [ids, data])

    # ``inline`` takes the struct apart after it was made once.
    return df.select(*[F.col(c) for c in df.columns], F.inline(F.array(both(F.col(text)))))


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""
    rows = round_trip(docs.select("doc_id", "text"), ranks_path, pattern).drop("text")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return digests(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
