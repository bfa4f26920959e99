"""Alignment of the tokens of two tokenizers over the same bytes, and counts of linked ids.

Both tokenizers part at a space between a visible character and a letter or digit, so a text is a
chain of units which can be aligned one by one. A range of a text's bytes is a fragment: an open
prefix up to its first cut, closed groups, and an open suffix after its last one. Two neighbouring
fragments compose to one, by closing what lies between them, and composing is associative. So very
long texts are cut into byte ranges wherever they fall, and their fragments composed in a tree.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.lookups import sums_by_row
from llm.tables import runs, shuffle_partitions, store
from llm.words import BLOCK_BYTES, _buffers, byte_hashes

CHUNK = 1 << 15  # bytes of a text that one task takes at a time
JOINED = 1 << 12  # bytes of units that are encoded as one text
BATCH = 16  # fragments, or long texts, that a worker gets at a time
FAN = 3  # 2**FAN fragments compose to one in a round
MOST_UNITS, MOST_CACHED = 1 << 18, 1 << 25  # units of a task's cache, and their bytes; it is then emptied
LOW = 16  # bits of a pair that hold the second tokenizer's id

_byte = np.arange(256)
_VISIBLE = (_byte > 0x20) & (_byte < 0x7F)
_PLAIN = np.array([chr(c).isalnum() and c < 0x7F for c in range(256)])
_TRAIL, _LATIN = (_byte >= 0x80) & (_byte < 0xC0), (_byte >= 0xC3) & (_byte < 0xCA)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of the spaces at which both tokenizers part, whatever stands around.

    Before one is visible ASCII or a letter of U+00C0 to U+027F, behind it an ASCII letter or digit.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    before = np.concatenate([[0], data[:-1]])
    earlier = np.concatenate([[0, 0], data[:-2]])
    ahead = np.concatenate([data[1:], [0]])
    return np.flatnonzero((data == 0x20) & _PLAIN[ahead] & (_VISIBLE[before] | (_TRAIL[before] & _LATIN[earlier])))


@dataclass
class Closed:
    """What the closed units of a range add up to."""

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: bytes = b""  # `a1,a2|b1;a3|b2,b3`
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # distinct
    count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __add__(self, other: Closed) -> Closed:
        pair, count = summed(np.concatenate([self.pair, other.pair]), np.concatenate([self.count, other.count]))
        return Closed(
            self.ok and other.ok, self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups,
            self.n_links + other.n_links, b";".join(filter(None, (self.groups, other.groups))), pair, count,
        )


@dataclass
class Fragment:
    """A range of a text's bytes. Without a cut all of it is ``prefix`` and it is not ``parted``."""

    parted: bool
    prefix: bytes
    closed: Closed
    suffix: bytes


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of n."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _char_bytes() -> dict[str, int]:
    """Bytes of the characters that a byte-level vocabulary writes for them: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Table:
    """Byte strings by number."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def __len__(self) -> int:
        return len(self.size)

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i] + self.size[i]].tobytes()

    def joined(self, numbers: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
        """The strings of these numbers in a row, each with its mark behind it."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        out = self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[numbers] - (ends - size), size)]
        return out if marks is None else np.insert(out, ends, marks)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Their items, and the bounds of the lists in them."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, bounds[-1]), bounds


def _ends(unit: bytes) -> bool:
    """Whether a cut could follow."""
    return bool(_VISIBLE[unit[-1]]) or len(unit) > 1 and bool(_TRAIL[unit[-1]] and _LATIN[unit[-2]])


class Aligner:
    """Units of texts with their groups and links, each worked out once."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        char = _char_bytes()
        vocabulary = sorted((i, w) for w, i in self.a.get_vocab().items())
        bytes_a = {i: bytes(char[c] for c in w) if all(c in char for c in w) else w.encode() for i, w in vocabulary}
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        if max(bytes_a) >> 31 or len(pieces) >> LOW:
            raise ValueError("ids don't fit into a pair")
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of the second vocabulary crosses a space")
        self.bytes_a = Table([bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)])
        self.bytes_b = Table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.digits = Table([str(i).encode() for i in range(max(len(self.bytes_a), len(pieces)))])
        self.clear()

    def clear(self) -> None:
        self.number: dict[int, int] = {}
        self.held = 0
        self.groups: list[bytes] = []
        self.sums = np.zeros((1 << 12, 5), np.int64)  # ok, n_a, n_b, n_groups, n_links
        self.links = np.zeros(1 << 14, np.int64)
        self.at = np.zeros((1 << 12) + 1, np.int64)

    def learn(self, units: list[tuple[int, bytes]]) -> None:
        """Encode and align units that are not known yet.

        Units that begin and end as those between two cuts do are encoded many at a time. Texts
        that a tokenizer spells otherwise are taken apart, so that only the units at fault have no tokens.
        """
        plain = [bool(u) and bool(_PLAIN[u[0]]) and _ends(u) for _, u in units]
        texts: list[list[int]] = []
        size = JOINED
        for k, (_, u) in enumerate(units):
            if not plain[k]:
                continue
            if size + len(u) >= JOINED:
                texts.append([])
                size = 0
            texts[-1].append(k)
            size += len(u) + 1
        texts += [[k] for k in range(len(units)) if not plain[k]]
        bad = self._align([[units[k] for k in text] for text in texts])
        again = [[units[k]] for i in bad if len(texts[i]) > 1 for k in texts[i]]
        alone = [units[texts[i][0]] for i in bad if len(texts[i]) == 1] + [again[i][0] for i in self._align(again)]
        none = np.zeros(len(alone), np.int64)
        self._keep(alone, np.zeros((len(alone), 5), np.int64), none[:0], none, [b""] * len(alone))

    def _align(self, texts: list[list[tuple[int, bytes]]]) -> list[int]:
        """Keep the units of these texts, but for texts that are not what their tokens spell: their numbers."""
        if not texts:
            return []
        raw = [b"".join(b" " + u for _, u in text) for text in texts]
        strings = [r.decode("utf-8", "replace") for r in raw]
        sides = [
            _flat([e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]),
            _flat(self.b.encode([t[1:] for t in strings], num_threads=1)),
        ]
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        data = np.frombuffer(b"".join(raw), np.uint8)
        good = np.ones(len(texts), bool)
        for table, (ids, bounds) in zip((self.bytes_a, self.bytes_b), sides, strict=True):
            ends = np.concatenate([[0], np.cumsum(table.size[ids])])[bounds]
            good &= np.diff(ends) == np.diff(at)
            same = np.flatnonzero(good)
            if len(same):
                own = np.repeat(good, np.diff(bounds))
                spelt, given = table.joined(ids[own]), data[np.repeat(good, np.diff(at))]
                right = np.add.reduceat(spelt != given, np.concatenate([[0], np.cumsum(np.diff(at)[same])])[:-1]) == 0
                good[same] = right
        kept = [u for text, ok in zip(texts, good.tolist(), strict=True) if ok for u in text]
        (ids_a, end_a), (ids_b, end_b) = (
            (x := ids[np.repeat(good, np.diff(bounds))], np.cumsum(table.size[x]))
            for table, (ids, bounds) in zip((self.bytes_a, self.bytes_b), sides, strict=True)
        )
        if kept:
            self._keep(kept, *self._linked(np.cumsum([len(u) + 1 for _, u in kept]), ids_a, end_a, ids_b, end_b))
        return np.flatnonzero(~good).tolist()

    def _linked(self, unit_end, ids_a, end_a, ids_b, end_b):
        """Sums, links, links per unit and groups of units that both ids spell, from the ends of all in bytes."""
        start_a = np.concatenate([[0], end_a[:-1]])
        first = np.searchsorted(end_b, start_a, "right")
        n = np.searchsorted(end_b, end_a, "left") + 1 - first
        so_far = np.cumsum(n)
        other = np.arange(so_far[-1]) + np.repeat(first - (so_far - n), n)
        links = np.repeat(ids_a, n) << LOW | ids_b[other]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        upto = lambda ends: np.diff(np.searchsorted(ends, unit_end, "right"), prepend=0)
        per_unit = np.diff(so_far[np.searchsorted(end_a, unit_end)], prepend=0)
        sums = np.stack([np.ones(len(unit_end), np.int64), upto(end_a), upto(end_b), upto(both), per_unit], axis=1)
        # tokens in the order of writing: a group's first ids, then its second ones
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
        ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a[np.searchsorted(end_a, both)]] = ord("|")
        mark[place_b[np.searchsorted(end_b, both)]] = ord(";")
        text = self.digits.joined(ids, mark).tobytes()
        cut = np.cumsum(self.digits.size[ids] + 1)[np.cumsum(sums[:, 1] + sums[:, 2]) - 1].tolist()
        return sums, links, per_unit, [text[i : j - 1] for i, j in zip([0, *cut], cut, strict=False)]

    def _keep(self, units, sums, links, per_unit, groups) -> None:
        """Number the units and store what is known of them."""
        old, n = len(self.number), len(units)
        begin = self.at[old]
        while len(self.sums) < old + n:
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.at = np.concatenate([self.at, np.zeros(len(self.at) - 1, np.int64)])
        while len(self.links) < begin + len(links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.sums[old : old + n] = sums
        self.links[begin : begin + len(links)] = links
        self.at[old + 1 : old + 1 + n] = begin + np.cumsum(per_unit)
        self.groups += groups
        self.held += 8 * len(links) + sum(map(len, groups))
        self.number.update((h, old + k) for k, (h, _) in enumerate(units))

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the units data[start:end], which hold until the next call."""
        if len(self.number) > MOST_UNITS or self.held > MOST_CACHED:
            self.clear()
        hashes = byte_hashes(data, start, end)
        kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        new = [
            (h, data[start[k] : end[k]].tobytes())
            for h, k in zip(kinds.tolist(), first.tolist(), strict=True)
            if h not in self.number
        ]
        if new:
            self.learn(new)
        return np.fromiter((self.number[h] for h in kinds.tolist()), np.int64, len(kinds))[kind]

    def pairs(self, row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pair, n) of all links of the units, rows ascending."""
        wide = np.int64(1 << 32)
        kinds, times = summed(row * wide + number, np.ones(len(row), np.int64))
        row, number = np.divmod(kinds, wide)
        size = self.at[number + 1] - self.at[number]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[number] - (ends - size), size)
        pair, link = np.unique(self.links[place], return_inverse=True)
        keys, n = summed(np.repeat(row, size) * wide + link, np.repeat(times, size))
        row, link = np.divmod(keys, wide)
        return row, pair[link], n

    def texts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[bytes], tuple]:
        """Sums (ok, n_a, n_b, n_groups, n_links) and groups of the texts data[at[i]:at[i + 1]], and their pairs."""
        space = cuts(data)
        row = np.searchsorted(at, space, "right") - 1
        space = space[(space > at[row]) & (space + 1 < at[row + 1])]
        begins = at[:-1][at[1:] > at[:-1]]
        ends = at[1:][at[1:] > at[:-1]]
        start = np.sort(np.concatenate([begins, space + 1]))
        end = np.sort(np.concatenate([ends, space]))
        row = np.searchsorted(at, start, "right") - 1
        number = self.numbers(data, start, end)
        n = len(at) - 1
        bounds = np.searchsorted(row, np.arange(n + 1))
        so_far = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.sums[number], axis=0)])
        sums = so_far[bounds[1:]] - so_far[bounds[:-1]]
        units = np.diff(bounds)
        ok = (sums[:, 0] == units) & (units > 0)
        sums[:, 0] = ok
        sums[~ok] = 0
        kinds = number.tolist()
        groups = [
            b";".join([self.groups[k] for k in kinds[bounds[i] : bounds[i + 1]]]) if ok[i] else b"" for i in range(n)
        ]
        good = ok[row]
        return sums, groups, self.pairs(row[good], number[good])

    def closed(self, units: list[bytes]) -> Closed:
        """Units in order, added up."""
        if not units:
            return Closed()
        data = np.frombuffer(b"".join(units), np.uint8)
        end = np.cumsum([len(u) for u in units])
        number = self.numbers(data, end - [len(u) for u in units], end)
        ok, n_a, n_b, n_groups, n_links = self.sums[number].sum(axis=0)
        if ok < len(units):
            return Closed(ok=False)
        _, pair, n = self.pairs(np.zeros(len(number), np.int64), number)
        return Closed(True, int(n_a), int(n_b), int(n_groups), int(n_links), b";".join([self.groups[k] for k in number.tolist()]), pair, n)

    def fragment(self, data: bytes) -> Fragment:
        """The fragment of a range of bytes."""
        space = cuts(np.frombuffer(data, np.uint8))
        space = space[space > 0].tolist()
        if not space:
            return Fragment(False, data, Closed(), b"")
        units = [data[i + 1 : j] for i, j in zip(space, space[1:], strict=False)]
        return Fragment(True, data[: space[0]], self.closed(units), data[space[-1] + 1 :])

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of both ranges. What was open between them is cut anew, since cuts may lie on the border."""
        middle = self.fragment((left.suffix if left.parted else left.prefix) + right.prefix)
        if not (left.parted or right.parted):
            return middle
        if left.parted and not right.parted:
            if not middle.parted:
                return Fragment(True, left.prefix, left.closed, middle.prefix)
            return Fragment(True, left.prefix, left.closed + self.closed([middle.prefix]) + middle.closed, middle.suffix)
        inner = middle.closed + self.closed([middle.suffix]) if middle.parted else Closed()
        if not left.parted:
            return Fragment(True, middle.prefix, inner + right.closed, right.suffix)
        return Fragment(True, left.prefix, left.closed + self.closed([middle.prefix]) + inner + right.closed, right.suffix)

    def whole(self, f: Fragment) -> Closed:
        """A whole text, whose ends close what is open. A text that is empty or spelt otherwise has no tokens."""
        if not f.parted:
            out = self.closed([f.prefix]) if f.prefix else Closed(ok=False)
        else:
            out = self.closed([f.prefix]) + f.closed + self.closed([f.suffix])
        return out if out.ok else Closed(ok=False)


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def public_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


_SUMS = "n_a long, n_b long, n_groups long, n_links long"
_PAIRS = "pairs array<struct<key:long,n:long>>"
_ROW = f"row long, doc_id long, {_SUMS}, groups_sha256 string, {_PAIRS}"
_FRAGMENT = f"row long, doc_id long, at long, parted boolean, prefix binary, suffix binary, ok boolean, {_SUMS}, groups binary, {_PAIRS}"


def _lists(bounds: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.Array:
    items = pa.StructArray.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), items)


def _digest(groups: bytes) -> str:
    return hashlib.sha256(groups).hexdigest() if groups else ""


def _table(fragments: list[tuple[int, int | None, int, Fragment]]) -> pa.RecordBatch:
    """Fragments (row, doc_id, at, fragment) as a batch."""
    f = [x[3] for x in fragments]
    c = [x.closed for x in f]
    ints = lambda values: pa.array(list(values), pa.int64())
    bounds = np.concatenate([[0], np.cumsum([len(x.pair) for x in c])])
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays(
        [
            *(ints(x[k] for x in fragments) for k in range(3)),
            pa.array([x.parted for x in f]),
            pa.array([x.prefix for x in f], pa.binary()),
            pa.array([x.suffix for x in f], pa.binary()),
            pa.array([x.ok for x in c]),
            *(ints(getattr(x, name) for x in c) for name in ("n_a", "n_b", "n_groups", "n_links")),
            pa.array([x.groups for x in c], pa.binary()),
            _lists(bounds, np.concatenate(none + [x.pair for x in c]), np.concatenate(none + [x.count for x in c])),
        ],
        names=["row", "doc_id", "at", "parted", "prefix", "suffix", "ok", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
    )


def _read(table: pa.Table) -> Iterator[Fragment]:
    """The fragments of a few rows."""
    pairs = table.column("pairs").combine_chunks()
    at, items = np.asarray(pairs.offsets), pairs.values
    key, n = np.asarray(items.field(0)), np.asarray(items.field(1))
    fields = ("parted", "prefix", "suffix", "ok", "n_a", "n_b", "n_groups", "n_links", "groups")
    for i, (parted, prefix, suffix, *sums) in enumerate(zip(*(table.column(f).to_pylist() for f in fields), strict=True)):
        own = slice(at[i], at[i + 1])
        yield Fragment(parted, prefix, Closed(*sums, key[own], n[own]), suffix)


def aligned(docs: DataFrame, vocabularies: tuple[str, str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Rows of docs (doc_id, text, ...) as row (a key of its own), doc_id, sums, groups_sha256 and pairs (key, n).

    A pair's key holds the ids of both tokenizers. Texts of over ``chunk`` bytes are dealt over
    the tasks range by range.
    """
    paths = vocabularies or public_vocabularies()
    parts = shuffle_partitions(docs.sparkSession)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        for batch in batches:
            data, at = _buffers(batch.column(2))
            first, n = 0, len(at) - 1
            while first < n:
                last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_BYTES, "right")) - 1)
                bounds = at[first : last + 1]
                sums, groups, (row, key, times) = own.texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, last - first) for i in range(2)),
                        *(pa.array(sums[:, k]) for k in range(1, 5)),
                        pa.array(map(_digest, groups), pa.string()),
                        _lists(np.searchsorted(row, np.arange(last - first + 1)), key, times),
                    ],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
                )
                first = last

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for i, key in enumerate(keys):
                yield _table([(*key, own.fragment(batch.column(3)[i].as_py()))])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Fragment]]:
        own = aligner(*paths)
        for group in runs(batches, "row", "up"):
            yield group.slice(0, 1), reduce(own.compose, _read(group))

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, one in composed(batches):
            yield _table([(*(group.column(k)[0].as_py() for k in ("row", "doc_id", "up")), one)])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last round, and what is open of the texts; one worker of a task does both."""
        own = aligner(*paths)
        for group, one in composed(batches):
            c = own.whole(one)
            yield pa.RecordBatch.from_arrays(
                [
                    *(group.column(k).combine_chunks() for k in ("row", "doc_id")),
                    *(pa.array([x], pa.int64()) for x in (c.n_a, c.n_b, c.n_groups, c.n_links)),
                    pa.array([_digest(c.groups)]),
                    _lists(np.array([0, len(c.pair)]), c.pair, c.count),
                ],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = store(rows.filter(size <= chunk).mapInArrow(texts, _ROW), "aligned")

    data = F.encode("text", "utf-8")
    number = F.explode(F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / chunk).cast("int"))).alias("at")
    long = rows.filter(size > chunk).select("row", "doc_id", "text", number)
    long = long.select("row", "doc_id", F.col("at").cast("long"), F.substring(data, F.col("at") * chunk + 1, F.lit(chunk)))
    fragments = store(long.repartition(parts, "row", "at").mapInArrow(ranges, _FRAGMENT), "fragments", BATCH)
    last = fragments.agg(F.max("at")).first()[0] or 0
    while True:
        up = fragments.withColumn("up", F.shiftright("at", FAN)).repartition(parts, "row", "up").sortWithinPartitions("row", "up", "at")
        last >>= FAN
        if not last:
            break
        fragments = up.mapInArrow(rounds, _FRAGMENT)
    return short.unionByName(store(up.mapInArrow(finished, _ROW), "aligned", BATCH))


def align(docs: DataFrame, vocabularies: tuple[str, str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Every row of docs (doc_id, text, ...) aligned, as doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The first tokenizer reads a space and the text, the second the text. Groups end where tokens of
    both end; links join tokens that share bytes. A pair of ids counts as often as the whole table
    links it; a link is among the best if no other pair of its second id counts more. A null or
    empty text, or one that a tokenizer spells otherwise (normalised characters), has zeros and an
    empty digest, and its links don't count. Repeated rows count each for itself, with or without a
    doc_id. Columns but these two are not read, whatever their names.
    """
    rows = aligned(docs, vocabularies, chunk)
    items = rows.select("row", F.explode("pairs").alias("pair")).select("row", "pair.*")
    counts = store(items.groupBy("key").agg(F.sum("n").alias("weight")), "pairs")
    second = F.col("key").bitwiseAND(F.lit((1 << LOW) - 1))
    best = counts.groupBy(second.alias("second")).agg(F.max("weight").alias("most"))  # one row per id of a vocabulary
    values = counts.withColumn("second", second).join(F.broadcast(best), "second").select(
        "key", "weight", (F.col("weight") == F.col("most")).cast("long").alias("is_best")
    )
    total = counts.agg(F.sum("weight")).first()[0] or 0
    sums = sums_by_row(items, values, total, n_best=F.sum(F.col("n") * F.col("is_best")), count_sum=F.sum(F.col("n") * F.col("weight")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
