"""Exact repeats of word windows across documents, by recompression.

A recompression round renames a sequence of symbols twice: maximal runs of one symbol become one, then
pairs of a left and a right symbol become one, where sides are bits of the symbols' names, the same for
all texts. The second round works on the symbols of the first. Names are hashes of content, so all
tasks name equal symbols alike without a common dictionary. Each symbol carries the stretch of words
that its name and borders follow from; within it, whatever surrounds it, equal words are cut and named
alike.

Of each window the least symbol is taken whose stretch lies inside the window: it depends on the window
alone. Spark counts these symbols, with the ``PHRASE`` words they begin, over all texts; a window whose
symbol occurs once cannot be repeated and is done. The other windows are verified down to the words:
they are named as wholes (96 bits), and Spark finds each name's earliest start. All later starts are
repeats; their words are removed.

A window of 20 words has symbols of its own after two rounds in nearly all cases, and after three in
fewer places: there are then half as many anchors more to send. Windows without one (inside long runs,
say) take the phrase at a fixed place instead.

Rows between steps are packed: a task sorts names by target, sends each name once however often it
holds it, and settles what it can see itself. So a name that a third of all texts hold costs a row
per task. Texts travel in compressed packs.

Defined results: a null, empty or short text (fewer words than a window) loses nothing; very long
texts are read whole; columns other than id and text are not read; with a repeated id, a window is
earlier if its id or, ids being equal, its start is smaller, so equal rows of one id keep all their
words; a null id comes after all others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import Words, chunks, joined_names, mixed

WINDOW, PHRASE, ROUNDS = 20, 5, 2
#: Where a window without a symbol of its own takes its phrase, and the bit that marks such a place.
ELSEWHERE, FALLBACK = 7, np.uint32(1 << 31)
LAST = np.int64(2**63 - 1)
#: Names a task gathers before it sends them on.
FLUSH = 1 << 20
_MOST = np.uint64(2**64 - 1)
_ROW = "bucket int, kind int, name binary, more binary, doc binary, tag binary, pos binary"
_ROW_ARROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("name", "more", "doc", "tag", "pos"))]
)
#: Kinds of rows: names to settle; places that are settled; packs of texts; ids of exact copies.
NAMES, SETTLED, TEXTS, COPIES = 0, 1, 2, 3


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Symbols(NamedTuple):
    """A sequence of symbols: names, the words that each covers, and the words that decide on it."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def runs(self) -> Symbols:
        """Maximal runs of one symbol as one: their borders follow from the symbols next to them."""
        names = self.names
        first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        last = np.append(first[1:], len(names)) - 1
        size = last - first + 1
        made = names[first].copy()
        several = np.flatnonzero(size > 1)
        made[several] = mixed(made[several] * _MIX + size[several].astype(np.uint64))
        return Symbols(made, self.starts[first], self.ends[last], self._before()[first], self._after()[last])

    def _before(self) -> np.ndarray:
        """What decides on the symbol before each; the first one's lies outside."""
        return np.append(self.low[0] - 1, self.low[:-1])

    def _after(self) -> np.ndarray:
        return np.append(self.high[1:], self.high[-1] + 1)

    def pairs(self, seed: int) -> Symbols:
        """A left symbol and the right one behind it as one. What is a left symbol's lot follows from
        the next symbol, what is a right one's from the one before.
        """
        names = self.names
        right = (mixed(names + np.uint64(seed)) & np.uint64(1)).astype(bool)
        joins = np.append(~right[:-1] & right[1:], False)
        at = np.flatnonzero(~np.append(False, joins[:-1]))
        after = np.minimum(at + 1, len(names) - 1)
        made = names[at]
        both = np.flatnonzero(joins[at])
        made[both] = mixed(made[both] * _MIX + mixed(names[after[both]]))
        ends = np.where(joins[at], self.ends[after], self.ends[at])
        low = np.where(right[at], self._before()[at], self.low[at])
        high = np.where(right[at], self.high[at], self._after()[at])
        return Symbols(made, self.starts[at], ends, low, high)


def recompressed(words: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    at = np.arange(len(words))
    symbols = Symbols(words, at, at + 1, at, at + 1)
    for r in range(rounds if len(words) else 0):
        symbols = symbols.runs().pairs(2 * r + 1)
    return symbols


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the sequence, the place of its anchor; and the names by place.

    Places from the number of words on are those of windows without a symbol of their own.
    """
    total = len(words)
    phrases = np.resize(joined_names(words, PHRASE), total) if total >= PHRASE else np.zeros(total, np.uint64)
    n = total - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.concatenate([phrases, phrases])
    symbols = recompressed(words)
    names = phrases.copy()
    names[symbols.starts] = mixed(symbols.names * _MIX + phrases[symbols.starts])
    value = np.full(total, _MOST)
    value[symbols.starts] = names[symbols.starts]
    # how far a window must reach to the left and to the right of a start
    left, right = np.full(total, WINDOW, np.int16), np.full(total, WINDOW, np.int16)
    left[symbols.starts] = np.minimum(symbols.starts - symbols.low, WINDOW)
    right[symbols.starts] = np.minimum(np.maximum(symbols.high - symbols.starts, PHRASE), WINDOW + 1)
    best, place = np.full(n, _MOST), np.full(n, total + ELSEWHERE)
    for j in range(WINDOW - PHRASE + 1):
        part = slice(j, j + n)
        less = (value[part] < best) & (left[part] <= j) & (right[part] <= WINDOW - j)
        np.copyto(best, value[part], where=less)
        place[less] = j
    return np.arange(n) + place, np.concatenate([names, mixed(phrases + np.uint64(1))])


class Texts:
    """Words of some texts, their windows, and where these belong."""

    def __init__(self, texts: list[bytes]):
        self.words = Words(texts)
        names, bounds = self.words.names, self.words.bounds
        self.sizes = np.diff(bounds)
        self.of = np.repeat(np.arange(len(texts)), self.sizes)
        self.first = bounds[:-1]
        self.anchor, self.names = anchors(names)
        n = len(self.anchor)
        self.whole = self.of[:n] == self.of[WINDOW - 1 :] if n else np.zeros(0, bool)

    def local(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text of each place, and the place as texts are told of it."""
        total = len(self.of)
        word = places % max(total, 1)
        of = self.of[word]
        at = (word - self.first[of]).astype(np.uint32)
        return of, np.where(places < total, at, at | FALLBACK)

    def place(self, text: int, at: np.ndarray) -> np.ndarray:
        """Places from what text ``text`` was told."""
        return self.first[text] + (at & ~FALLBACK).astype(np.int64) + np.where(at & FALLBACK, len(self.of), 0)


def tags(texts: list[bytes]) -> np.ndarray:
    """Tell apart texts that share an id: two unlike ones are taken for one in 2^32 cases."""
    return np.array([int.from_bytes(hashlib.blake2b(t, digest_size=4).digest(), "little") for t in texts], np.uint32)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)


def _row(bucket: int, kind: int, **parts: np.ndarray) -> dict:
    return {"bucket": bucket, "kind": kind} | {k: v.tobytes() for k, v in parts.items()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ROW_ARROW)


def _doc_bucket(doc: np.ndarray, tag: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(doc.astype(np.uint64) * np.uint64(65537) + tag) % np.uint64(buckets)).astype(np.int64)


def _by(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each target value."""
    order = np.argsort(target, kind="stable")
    edges = np.flatnonzero(np.diff(target[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        yield int(target[order[a]]), order[a:b]


def _settled(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, buckets: int) -> list[dict]:
    return [
        _row(b, SETTLED, doc=doc[r], tag=tag[r], pos=pos[r]) for b, r in _by(_doc_bucket(doc, tag, buckets))
    ] if len(doc) else []


class Gathered:
    """Names with their places, gathered over chunks."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def take(self) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.size = [], 0
        return columns


def _anchor_rows(gathered: Gathered, buckets: int) -> list[dict]:
    """A row per target: names held once with their place, names held more often without.

    Places of the latter are settled: those anchors do occur again.
    """
    name, doc, tag, pos = gathered.take()
    order = np.argsort(name, kind="stable")
    name, doc, tag, pos = name[order], doc[order], tag[order], pos[order]
    new = np.append(True, name[1:] != name[:-1])
    count = np.diff(np.append(np.flatnonzero(new), len(name)))
    often = np.repeat(count > 1, count)
    rows = _settled(doc[often], tag[often], pos[often], buckets)
    target = (name >> np.uint64(20)) % np.uint64(buckets)
    once = ~often
    for b, r in _by(np.where(once, target, buckets).astype(np.int64)):
        if b < buckets:
            rows.append(_row(b, NAMES, name=name[r], doc=doc[r], tag=tag[r], pos=pos[r]))
    heads = np.flatnonzero(new & often)
    for b, r in _by(target[heads].astype(np.int64)) if len(heads) else ():
        rows.append(_row(b, NAMES, name=np.repeat(name[heads[r]], 2), doc=np.zeros(0), tag=np.zeros(0), pos=np.zeros(0)))
    return rows


def _name_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered()
        for batch in batches:
            ids, texts = _ids(batch.column(0)), batch.column(1).to_pylist()
            for first, part in chunks(texts):
                t = Texts(part)
                used = np.zeros(len(t.names), bool)
                used[t.anchor[t.whole]] = True
                places = np.flatnonzero(used)
                if len(places):
                    of, at = t.local(places)
                    gathered.add(t.names[places], ids[first + of], tags(part)[of], at)
                if gathered.size >= FLUSH:
                    yield _batch(_anchor_rows(gathered, buckets))
        if gathered.size:
            yield _batch(_anchor_rows(gathered, buckets))

    return run


def _column(table: pa.Table, name: str, kind: type | np.dtype, rows: np.ndarray) -> np.ndarray:
    column = table.column(name).to_pylist()
    return np.frombuffer(b"".join(column[i] for i in rows), kind)


def _kinds(table: pa.Table) -> np.ndarray:
    return table.column("kind").to_numpy()


def _repeated_anchors(buckets: int):
    def settle(table: pa.Table) -> pa.Table:
        """The places of anchors whose name occurs at least twice; settled places pass through."""
        kinds = _kinds(table)
        rows = np.flatnonzero(kinds == NAMES)
        out = table.filter(pa.array(kinds == SETTLED)).to_pylist()
        doc_sizes = [len(d) // 8 for d in table.column("doc").to_pylist()]
        placed = np.array([i for i in rows if doc_sizes[i]], np.int64)
        bare = np.array([i for i in rows if not doc_sizes[i]], np.int64)
        if len(placed):
            name = _column(table, "name", np.uint64, placed)
            seen, count = np.unique(np.concatenate([name, _column(table, "name", np.uint64, bare)]), return_counts=True)
            hit = np.flatnonzero(count[np.searchsorted(seen, name)] > 1)
            doc, tag = _column(table, "doc", np.int64, placed)[hit], _column(table, "tag", np.uint32, placed)[hit]
            out += _settled(doc, tag, _column(table, "pos", np.uint32, placed)[hit], buckets)
        return pa.Table.from_pylist(out, schema=_ROW_ARROW)

    return settle


def _pack_texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        size = 0
        packer = zstandard.ZstdCompressor(level=1)

        def flush() -> pa.RecordBatch:
            rows = []
            for b, docs in held.items():
                lengths = np.array([len(t) for _, t in docs], np.int64)
                pack = packer.compress(b"".join(t for _, t in docs))
                rows.append(_row(b, TEXTS, doc=np.array([i for i, _ in docs], np.int64), pos=lengths) | {"more": pack})
            held.clear()
            return _batch(rows)

        for batch in batches:
            ids, texts = _ids(batch.column(0)), [t or b"" for t in batch.column(1).to_pylist()]
            target = _doc_bucket(ids, tags(texts), buckets)
            for b, i, t in zip(target.tolist(), ids.tolist(), texts):
                held[b].append((i, t))
                size += len(t)
                if size >= 32 << 20:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def _unpacked(table: pa.Table, kinds: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and texts of a bucket, some megabytes at a time."""
    for i in np.flatnonzero(kinds == TEXTS):
        ids = np.frombuffer(table.column("doc")[i].as_py(), np.int64)
        lengths = np.frombuffer(table.column("pos")[i].as_py(), np.int64)
        data = zstandard.ZstdDecompressor().decompress(table.column("more")[i].as_py())
        ends = np.cumsum(lengths)
        texts = [data[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
        for first, part in chunks(texts):
            yield ids[first : first + len(part)], part


def _marks(table: pa.Table, kinds: np.ndarray) -> tuple[dict[tuple[int, int], np.ndarray], set[tuple[int, int]]]:
    """Settled places by (id, tag), and the (id, tag) of exact copies."""
    rows = np.flatnonzero(kinds == SETTLED)
    found: dict[tuple[int, int], np.ndarray] = {}
    if len(rows):
        doc, tag, pos = (_column(table, c, k, rows) for c, k in (("doc", np.int64), ("tag", np.uint32), ("pos", np.uint32)))
        order = np.lexsort((tag, doc))
        doc, tag, pos = doc[order], tag[order], pos[order]
        edges = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
        for a, b in zip(edges, [*edges[1:], len(doc)]):
            found[int(doc[a]), int(tag[a])] = pos[a:b]
    copies: set[tuple[int, int]] = set()
    for i in np.flatnonzero(kinds == COPIES):
        doc, tag = table.column("doc")[i].as_py(), table.column("tag")[i].as_py()
        copies |= set(zip(np.frombuffer(doc, np.int64).tolist(), np.frombuffer(tag, np.uint32).tolist()))
    return found, copies


def _window_rows(gathered: Gathered, buckets: int) -> list[dict]:
    """Names with their earliest place here; later places are settled: they are repeats."""
    h, g, doc, tag, pos = gathered.take()
    order = np.lexsort((pos, doc, g, h))
    h, g, doc, tag, pos = h[order], g[order], doc[order], tag[order], pos[order]
    new = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[head]) | (pos != pos[head])
    rows = _settled(doc[later], tag[later], pos[later], buckets)
    stay = np.flatnonzero(~later)
    for b, r in _by(((h[stay] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)):
        r = stay[r]
        rows.append(_row(b, NAMES, name=h[r], more=g[r], doc=doc[r], tag=tag[r], pos=pos[r]))
    return rows


def _name_windows(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        marked, copies = _marks(table, kinds)
        gathered, rows = Gathered(), []
        for ids, texts in _unpacked(table, kinds):
            t, tag = Texts(texts), tags(texts)
            if not len(t.anchor):
                continue
            again = np.zeros(len(t.names), bool)
            for d, key in enumerate(zip(ids.tolist(), tag.tolist())):
                if key in marked and key not in copies:
                    again[t.place(d, marked[key])] = True
            at = np.flatnonzero(again[t.anchor] & t.whole)
            if not len(at):
                continue
            h = joined_names(t.words.names, WINDOW, seed=11)[at]
            g = (joined_names(t.words.names, WINDOW, seed=12)[at] >> np.uint64(32)).astype(np.uint32)
            of = t.of[at]
            gathered.add(h, g, ids[of], tag[of], (at - t.first[of]).astype(np.uint32))
            if gathered.size >= FLUSH:
                rows += _window_rows(gathered, buckets)
        if gathered.size:
            rows += _window_rows(gathered, buckets)
        return pa.Table.from_pylist(rows, schema=_ROW_ARROW)

    return run


def _later_windows(buckets: int):
    def settle(table: pa.Table) -> pa.Table:
        kinds = _kinds(table)
        out = table.filter(pa.array(kinds == SETTLED)).to_pylist()
        rows = np.flatnonzero(kinds == NAMES)
        if len(rows):
            gathered = Gathered()
            types = (("name", np.uint64), ("more", np.uint32), ("doc", np.int64), ("tag", np.uint32), ("pos", np.uint32))
            gathered.add(*(_column(table, c, k, rows) for c, k in types))
            out += [r for r in _window_rows(gathered, buckets) if r["kind"] == SETTLED]
        return pa.Table.from_pylist(out, schema=_ROW_ARROW)

    return settle


def _remove(table: pa.Table) -> pa.Table:
    kinds = _kinds(table)
    marked, copies = _marks(table, kinds)
    found: list[tuple] = []
    for ids, texts in _unpacked(table, kinds):
        for doc, tag, text in zip(ids.tolist(), tags(texts).tolist(), texts):
            words = text.split()
            key, n = (doc, tag), len(words)
            gone = np.zeros(n, bool)
            if key in copies and n >= WINDOW:
                gone[:] = True
            elif key in marked:
                depth = np.zeros(n + 1, np.int64)
                starts = np.unique(marked[key]).astype(np.int64)
                depth[starts] += 1
                depth[starts + WINDOW] -= 1
                gone = np.cumsum(depth[:n]) > 0
            left = [w for w, x in zip(words, gone.tolist()) if not x] if gone.any() else words
            found.append((None if doc == LAST else doc, n, int(gone.sum()), hashlib.sha256(b" ".join(left)).hexdigest(), b" ".join(left).decode("utf-8", "replace")))
    columns = list(zip(*found)) or [()] * 5
    types = [pa.int64()] * 3 + [pa.string()] * 2
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _copy_rows(source: DataFrame, buckets: int) -> DataFrame:
    """Texts that a smaller id has as a whole: all their windows start earlier there."""
    hashed = source.select(F.coalesce("id", F.lit(int(LAST))).alias("id"), F.md5("text").alias("hash"), F.octet_length("text").alias("n"), "text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy().astype(np.uint32)
            yield _batch([_row(b, COPIES, doc=doc[r], tag=tag[r]) for b, r in _by(_doc_bucket(doc, tag, buckets))] if len(doc) else [])

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = tags([t or b"" for t in batch.column(3).to_pylist()]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], names=["id", "hash", "n", "tag"])

    narrow = hashed.mapInArrow(tagged, "id bigint, hash string, n int, tag bigint")
    first = narrow.groupBy("hash", "n").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = narrow.join(first.hint("merge"), ["hash", "n"]).where("id > first").select("id", "tag")
    return later.mapInArrow(mark, _ROW)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text.

    ``buckets`` is the number of groups that names and texts are dealt to; by default some per
    partition of the scan, so that a group stays at a few tens of megabytes.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    buckets = buckets or max(24, 3 * source.rdd.getNumPartitions())
    named = source.mapInArrow(_name_anchors(buckets), _ROW)
    again = named.groupBy("bucket").applyInArrow(_repeated_anchors(buckets), _ROW)
    packs = source.mapInArrow(_pack_texts(buckets), _ROW)
    copies = _copy_rows(source, buckets)
    windows = packs.unionAll(again).unionAll(copies).groupBy("bucket").applyInArrow(_name_windows(buckets), _ROW)
    later = windows.groupBy("bucket").applyInArrow(_later_windows(buckets), _ROW)
    marked = packs.unionAll(later).unionAll(copies)
    return marked.groupBy("bucket").applyInArrow(
        _remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
