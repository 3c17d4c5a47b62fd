"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte-pair vocabulary every byte prefix of a text has exactly one token
that can end its encoding. ``PrefixEncoder`` stores that token for each
prefix, so an encoding is read off backwards, bytes can be appended without
touching what is stored, and after an edit only the prefixes from the edit to
the next point of agreement are computed again.

A token ``t`` may follow the last token ``p`` of the prefix before it if the
merges, run on the bytes of ``p`` and ``t`` together, leave exactly these two;
such answers are remembered by pair. Time is linear in the bytes.

Results at the edges: a null text is an empty one; an empty text has no ids,
``n_tokens`` 0, and both digests are those of the empty byte string. Repeated
rows give repeated results; other columns of the table are not read, so any
names may clash. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import DataFrame

from lendgrade.llm.common import score_partitions

#: Pieces kept by a worker with their ids, and the longest piece kept.
CACHE_PIECES, CACHE_LENGTH = 1_000_000, 48


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The tokens of a rank file: one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, data.splitlines()))}


class Vocabulary:
    """Tokens by rank, with what the prefix encoder looks up."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.length_of = {r: len(t) for t, r in ranks.items()}
        self.decimal = {r: str(r) for r in self.bytes_of}
        self.pair_ok: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # a token that its own bytes do not merge to never ends an encoding
            if len(token) == 1 or self.merged(token) == [rank]:
                self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        self.ends.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """Ids of a short byte string by the merges themselves."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best = min(((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1)))
            if best[0] == 1 << 40:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    def follows(self, first: int, second: int) -> bool:
        """Whether ``second`` can stand after ``first`` in an encoding."""
        if len(self.pair_ok) > 2_000_000:
            self.pair_ok.clear()
        ok = self.merged(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
        self.pair_ok[first << 32 | second] = ok
        return ok

    def extend(self, last: list[int], data: bytes) -> list[int]:
        """Append to ``last``, which covers the first bytes of ``data``, the
        last tokens of all longer prefixes."""
        known, follows = self.pair_ok.get, self.follows
        done = len(last) - 1
        begin = max(0, done + 1 - self.longest)
        for end, (length, rank) in self.ends.iter(data[begin:].decode("latin-1")):
            at = begin + end + 1
            if at <= done:  # a longer token already ends here
                continue
            before = at - length
            if before > 0:
                first = last[before]
                ok = known(first << 32 | rank)
                if not (follows(first, rank) if ok is None else ok):
                    continue
            elif before < 0:  # begins in bytes that are not scanned again
                continue
            last.append(rank)
            done = at
        if done < len(data):
            raise ValueError("the vocabulary does not cover these bytes")
        return last

    def read_back(self, last: list[int]) -> list[int]:
        """The ids of the encoding whose last tokens by prefix are given."""
        out, at, length = [], len(last) - 1, self.length_of
        while at:
            rank = last[at]
            out.append(rank)
            at -= length[rank]
        return out[::-1]


class PrefixEncoder:
    """The encoding of a growing or edited byte string.

    ``last[i]`` is the last token of the encoding of the first ``i`` bytes.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        if data:
            self.append(data)

    def append(self, more: bytes) -> int:
        """Add bytes at the end; the stored prefixes stay as they are.
        Returns how many prefixes were computed."""
        self.data += more
        self.vocabulary.extend(self.last, self.data)
        return len(more)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes ``start`` to ``stop``.

        The prefixes up to ``start`` stay. Behind the new bytes, the entries
        are computed until as many in a row agree with the former ones as a
        token can be long: from there on all agree. Returns how many
        prefixes were computed."""
        voc, tail = self.vocabulary, self.last[stop + 1 :]
        self.data = self.data[:start] + new + self.data[stop:]
        last, at = self.last[: start + 1], start + len(new)
        voc.extend(last, self.data[:at])
        agree = 0
        while at < len(self.data) and agree < voc.longest:
            stride = min(voc.longest, len(self.data) - at)
            voc.extend(last, self.data[: at + stride])
            for _ in range(stride):
                agree = agree + 1 if last[at + 1] == tail[at - start - len(new)] else 0
                at += 1
        self.last = last + tail[at - start - len(new) :]
        return at - start

    def ids(self) -> list[int]:
        return self.vocabulary.read_back(self.last)


class TextEncoder:
    """Encodes whole texts: splits them by ``pattern``, looks a piece up whole
    and else takes the prefix encoding of its bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.find = regex.compile(pattern).findall
        self.gap = regex.compile(r"\s ").search
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.parts: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        ids = self.pieces.get(text)
        if ids is None:
            data, voc = text.encode("utf-8", "replace"), self.vocabulary
            whole = voc.ranks.get(data)
            ids = (whole,) if whole is not None else tuple(voc.read_back(voc.extend([-1], data)))
            if len(text) <= CACHE_LENGTH:
                if len(self.pieces) >= CACHE_PIECES:
                    self.pieces.clear()
                self.pieces[text] = ids
        return ids

    def part(self, text: str) -> tuple[int, ...]:
        found = self.find(text)
        ids = self.piece(text) if len(found) == 1 else tuple(chain.from_iterable(map(self.piece, found)))
        if len(text) <= CACHE_LENGTH:
            if len(self.parts) >= CACHE_PIECES:
                self.parts.clear()
            self.parts[text] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        Where a single space follows a character other than white space, a
        match of the pattern always ends. Texts whose spaces are all of this
        kind are cut there, and the parts, which repeat, are looked up;
        other texts are matched whole.
        """
        if self.gap(text) is None:
            parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.find(text)
            if parts and not parts[0]:
                parts = parts[1:]
            known, new = self.parts.get, self.part
        else:
            parts, known, new = self.find(text), self.pieces.get, self.piece
        return list(chain.from_iterable([known(p) or new(p) for p in parts]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def worker_encoder(data: bytes, pattern: str) -> TextEncoder:
    """The encoder of this Python worker, built once for a vocabulary."""
    key = (hashlib.sha1(data).hexdigest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(read_ranks(data), pattern)
    return _ENCODERS[key]


def encode_texts(df: DataFrame, rank_file: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``ids`` (array) and ``decoded`` (binary) of each text.

    ``rank_file`` is read on the driver and sent to the executors once; its
    size is that of a vocabulary and does not grow with the data.
    """
    return _encoded(df, rank_file, pattern, text, keep or [], "ids array<int>, decoded binary", lambda enc, ids, raw: (ids, raw))


def encode_digests(df: DataFrame, rank_file: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``n_tokens``, and the SHA-256 of the ids (decimal,
    joined by one space) and of the bytes decoded from them."""

    def digest(enc: TextEncoder, ids: list[int], raw: bytes) -> tuple:
        decimal = " ".join(map(enc.vocabulary.decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()

    return _encoded(df, rank_file, pattern, text, keep or [], "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)


def _encoded(df, rank_file, pattern, text, keep, schema, result) -> DataFrame:
    with open(rank_file, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def run(texts: list[str]):
        enc = worker_encoder(sent.value, pattern)
        for t in texts:
            ids = enc.encode(t)
            yield result(enc, ids, enc.decode(ids))

    return score_partitions(df, run, text, keep, schema)
