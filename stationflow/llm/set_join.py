"""Exact Jaccard join of shingle sets that uses how sets relate to each other.

Texts with equal sets form a class, and one of each class takes part. The shingles of a set stand in the order of
their hashes. Sets that are similar enough share some of the first ones: those are looked up in index lists.

Skipping in the index: a list is in the order of the positions its shingle has in the sets. Linked sets have a
shingle they share at nearly the same position, so an entry reads the block of the list in reach of its own
position and skips the others. A bitmap of each set bounds from below in how many shingles two sets differ. A
set looks up twice the shingles it must, and so shares many of them with each set it is linked to:
pairs that share fewer are dropped before any sets are compared.

Skipping answers: a set is compared with one of its candidates; what it shares with the others follows, within
bounds, from what that one shares with them, which is computed once for all sets that are like it. Only where
bounds leave it open are two sets compared. Each set is compared with the least of its candidates first; pairs of sets that are connected
already are skipped. What that leaves stays packed, a row for each set, and goes to rooms by the groups that candidates make up:
a group's sets are sent to its room once, and there a link found saves all pairs between the two components it connects.

A list with more than `most` entries is not read. A set finds all its links if few enough of its lists are that
long. If not, the set is looked up by segments as well: shingles are dealt into more segments than linked sets can
differ in, so linked sets have one in common throughout. A long list of segments compares all with its
least set, and then only what that has left unconnected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import PAGE, answered, chunked, paged, read_answers, write_pages
from .components import components
from .shared import saved, small_batches
from .tokens import Words, mixed, pieces, window_hashes

#: Bytes of text of a chunk: what a task makes of it is many times that.
CHUNK_BYTES = 4 << 20
#: Entries of an index list from which on it isn't read.
MOST = 256
#: So many keys of sets to compare, eight bytes each, are broadcast.
FEW_KEYS = 500_000
#: Bytes of sets of either side that are compared in one task, and pairs of them.
ROOM_BYTES = 8 << 20
ROOM_PAIRS = 100_000
_ONCE, _SOME, _MANY = 0, 1, 2
_BITS = 256

ENTRY = np.dtype([("list", np.uint64), ("key", np.int64), ("size", np.int32), ("at", np.int32), ("need", np.int32), ("bits", np.uint64, _BITS // 64)])


class Sets:
    """Shingle sets of a run of texts: sorted distinct hashes, those of row r from first[r] up to first[r + 1]."""

    def __init__(self, words: Words, rows: int, shingle: int):
        row, hashes = [], []
        for length in range(1, shingle + 1):
            # A text of fewer words than a shingle is one shingle as a whole.
            h = window_hashes(words.hash, length)
            at = np.flatnonzero(words.row[: len(h)] == words.row[length - 1 :]) if len(h) else np.zeros(0, np.int64)
            if length < shingle:
                at = at[words.count[words.row[at]] == length]
            row.append(words.row[at])
            hashes.append(h[at])
        row, hashes = np.concatenate(row), np.concatenate(hashes)
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        self.row, self.hashes = row[new], hashes[new]
        self.first = np.searchsorted(self.row, np.arange(rows + 1))
        self.size = np.diff(self.first)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums that name each set."""
        out = []
        for salt in (0x1F123BB5, 0x5851F42D4C957F2D):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(self.hashes ^ np.uint64(salt)), dtype=np.uint64)))
            out.append((sums[self.first[1:]] - sums[self.first[:-1]]).view(np.int64))
        return out[0], out[1]


def least_shared(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set shares with any it is linked to, at least."""
    return -(-percent * size // 100)


def spare(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles looked up beyond those that must be: so many long lists a set can do without."""
    least = least_shared(size, percent)
    return np.maximum(np.minimum(size - least, least - 1), 0)


def most_different(size: np.ndarray, percent: int) -> np.ndarray:
    """Of two linked sets with `size` shingles in all: shingles in one only, at most."""
    return size * (100 - percent) // (100 + percent)


def _texts(table: pa.Table, told: pa.Table, shingle: int, lower: bool) -> Iterator[tuple[list[int], Sets]]:
    """Classes and sets of the rows of a chunk that lead a class: told has their names, and the class as page, at level -1."""
    led = told.filter(pc.equal(told.column("level"), -1))
    names = pa.array([int.from_bytes(x, "little", signed=True) for x in led.column("answer").to_pylist()], pa.int64())
    at = pc.index_in(table.column("name"), value_set=names)
    table = pa.table({"class": led.column("page").take(at), "text": table.column("text")}).filter(pc.is_valid(at))
    for part, run in pieces(iter(table.combine_chunks().to_batches())):
        yield part.column("class").to_pylist(), Sets(Words(run, lower), run.rows, shingle)


def _once(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Of the rows of a task that are equal in some columns the first."""
    seen: set[tuple[int, ...]] = set()
    for batch in batches:
        new = []
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            new.append(row not in seen)
            seen.add(row)
        yield batch.filter(pa.array(new, pa.bool_()))


class _Looked:
    """What some sets look up: their first shingles."""

    def __init__(self, keys: list[int], sets: Sets, percent: int):
        self.keys, self.sets = np.array(keys, dtype=np.int64), sets
        size = sets.size
        take = np.minimum(size - least_shared(size, percent) + 1 + spare(size, percent), size)
        at = np.arange(len(sets.hashes)) - sets.first[sets.row]
        chosen = at < take[sets.row]
        self.row, self.at, self.hashes = sets.row[chosen], at[chosen], sets.hashes[chosen]

    def bits(self) -> np.ndarray:
        """Of each set one bit per residue: whether an odd number of shingles have it."""
        n = len(self.keys)
        bit = (self.sets.hashes >> np.uint64(20)) % np.uint64(_BITS)
        odd = np.bincount(self.sets.row * _BITS + bit.astype(np.int64), minlength=n * _BITS).reshape(n, _BITS) & 1
        return np.packbits(odd.astype(np.uint8), axis=1).view(np.uint64)

    def entries(self, which: np.ndarray, need: np.ndarray) -> np.ndarray:
        """need: of each set, so many entries it shares with any set it is linked to."""
        out = np.empty(int(which.sum()), dtype=ENTRY)
        row = self.row[which]
        out["list"], out["key"], out["size"], out["at"], out["need"], out["bits"] = self.hashes[which], self.keys[row], self.sets.size[row], self.at[which], need[row], self.bits()[row]
        return out

    def segments(self, rows: np.ndarray, percent: int) -> np.ndarray:
        """Entries of the segments of some sets. Sizes are cut into bands no linked pair spans more than two of;
        a set has the segments of its band with the one below and of its band with the one above."""
        sets, bits, out = self.sets, self.bits(), []
        for row in rows.tolist():
            hashes, size = sets.hashes[sets.first[row] : sets.first[row + 1]], int(sets.size[row])
            low, edges = 1, [1]
            while low <= size:
                low = -(-100 * low // percent) + 1
                edges.append(low)
            band = len(edges) - 2
            for pair in (band - 1, band):
                high = edges[band + 1] if pair < band else -(-100 * edges[band + 1] // percent) + 1
                count = int(most_different(np.int64(2 * (high - 1)), percent)) + 1
                segment = (mixed(hashes) % np.uint64(count)).astype(np.int64)
                sums = np.zeros(count, dtype=np.uint64)
                np.add.at(sums, segment, mixed(hashes ^ np.uint64(0x2545F4914F6CDD1D)))
                entry = np.empty(count, dtype=ENTRY)
                place = np.arange(count, dtype=np.uint64) + np.uint64((pair + 2) << 32)
                entry["list"], entry["key"], entry["size"], entry["at"], entry["need"], entry["bits"] = mixed(sums + mixed(place)), self.keys[row], size, -1, 1, bits[row]
                out.append(entry)
        return np.concatenate(out) if out else np.empty(0, dtype=ENTRY)


def _how_often(most: int):
    def decide(chunk: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        _, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=counts)[at]
        return np.where(total < 2, _ONCE, np.where(total <= most, _SOME, _MANY))

    return decide


def read_lists(entries: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of the same list that may be linked, as places in entries, which are in the order of list and position.

    All lists are read at once: each entry with the next one, those still in reach with the one after that, and so on.
    """
    size, at = entries["size"].astype(np.int64), entries["at"].astype(np.int64)
    # Ahead of a shared shingle stand at most as many others as the sets differ in.
    reach = at + most_different(size + size * 100 // percent, percent)
    firsts, seconds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    active, step = np.arange(len(entries) - 1), 1
    while len(active):
        active = active[active + step < len(entries)]
        other = active + step
        on = (entries["list"][active] == entries["list"][other]) & (at[other] <= reach[active])
        active, other = active[on], other[on]
        low, high = np.minimum(size[active], size[other]), np.maximum(size[active], size[other])
        near = (percent * high <= 100 * low) & (entries["key"][active] != entries["key"][other])
        a, b = active[near], other[near]
        differ = np.bitwise_count(entries["bits"][a] ^ entries["bits"][b]).sum(axis=1, dtype=np.int64)
        may = differ <= most_different(size[a] + size[b], percent)
        firsts.append(a[may])
        seconds.append(b[may])
        step += 1
    return np.concatenate(firsts), np.concatenate(seconds)


#: What reading the lists of a page gives: its pairs together (kind 0), or an entry of a list too long to be read (kind 1).
READ = "kind int, chunk long, page long, keys binary, values binary, a long, list long, size int, b0 long, b1 long, b2 long, b3 long"

PAIR = np.dtype([("a", np.int64), ("b", np.int64), ("shared", np.int32), ("need", np.int32)])


def _pairs(a: np.ndarray, b: np.ndarray, shared: np.ndarray, need: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), dtype=PAIR)
    out["a"], out["b"], out["shared"], out["need"] = np.minimum(a, b), np.maximum(a, b), shared, need
    return out


def _pair_pages(page: int, pairs: np.ndarray, n: int) -> pa.Table:
    """Pairs in pages by what the greater key hashes to: all that a key has with lesser ones are added up in one."""
    names = mixed(pairs["b"].view(np.uint64))
    order = paged(names, n)
    table = write_pages(page, names[order], np.ascontiguousarray(pairs[order]), n)
    none = pa.nulls(table.num_rows, pa.int64())
    columns = {"kind": pa.array(np.zeros(table.num_rows, dtype=np.int32)), **{c: table.column(c) for c in table.column_names}}
    return pa.table({**columns, "a": none, "list": none, "size": none.cast(pa.int32()), **{f"b{i}": none for i in range(4)}})


def _add_pairs(table: pa.Table) -> pa.Table:
    """Pairs that are in as many lists together as linked sets must be: a star (see `_star`) and the others."""
    pairs = np.concatenate([np.frombuffer(x, dtype=PAIR) for x in table.column("values").to_pylist()])
    pairs = pairs[np.lexsort((pairs["a"], pairs["b"]))]
    begin = np.flatnonzero(np.concatenate(([True], (pairs["a"][1:] != pairs["a"][:-1]) | (pairs["b"][1:] != pairs["b"][:-1]))))
    shared, need = np.add.reduceat(pairs["shared"], begin), np.minimum.reduceat(pairs["need"], begin)
    enough = begin[shared >= need]
    return _star(table.column("page")[0].as_py(), pairs["a"][enough], pairs["b"][enough])


#: Of the pairs of a page: one for each greater key, and all others together.
STAR = "a long, b long, page long, others binary"


def _star(page: int, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Pairs in the order of b, then a. Each b with its least a, a row each; the others as they are, in one row."""
    least = np.ones(len(b), dtype=bool)
    least[1:] = b[1:] != b[:-1]
    others = np.stack([a[~least], b[~least]], axis=1).astype("<i8").tobytes()
    n = int(least.sum())
    return pa.table({
        "a": pa.array([*a[least].tolist(), None], pa.int64()),
        "b": pa.array([*b[least].tolist(), None], pa.int64()),
        "page": pa.array([page] * (n + 1), pa.int64()),
        "others": pa.array([*[None] * n, others], pa.binary()),
    })


def _labelled(labels: pa.Table, keys: np.ndarray) -> np.ndarray:
    """The component of each key: itself where it has no label."""
    key, component = (labels.column(c).to_numpy() for c in ("key", "component"))
    if not len(key):
        return keys.copy()
    order = np.argsort(key)
    at = np.minimum(np.searchsorted(key[order], keys), len(key) - 1)
    return np.where(key[order][at] == keys, component[order][at], keys)


def _pages_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


def unconnected(stars: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """Of the other pairs, those whose ends are in different components: a row (b, lesser) for each greater key. Components
    (node, component) go to the pages of their nodes: there pairs learn that of their greater key first, then that of the lesser one."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page = _pages_of(batch.column("node").to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(page), batch.column("node"), batch.column("component")], names=["page", "key", "component"])

    def in_pages(rows: np.ndarray, keys: np.ndarray) -> pa.Table:
        page = _pages_of(keys, n)
        order = np.argsort(page, kind="stable")
        edges = np.flatnonzero(np.diff(page[order], prepend=-1))
        parts = np.split(rows[order], edges[1:]) if len(order) else []
        return pa.table({"page": pa.array(page[order][edges], pa.int64()), "others": pa.array([x.astype("<i8").tobytes() for x in parts], pa.binary())})

    def learn_greater(pairs: pa.Table, labels: pa.Table) -> pa.Table:
        rows = np.concatenate([np.zeros(0, "<i8"), *[np.frombuffer(x, "<i8") for x in pairs.column("others").to_pylist()]]).reshape(-1, 2)
        rows = np.concatenate([rows, _labelled(labels, rows[:, 1])[:, None]], axis=1)
        return in_pages(rows, rows[:, 0])

    def learn_lesser(pairs: pa.Table, labels: pa.Table) -> pa.Table:
        rows = np.concatenate([np.zeros(0, "<i8"), *[np.frombuffer(x, "<i8") for x in pairs.column("others").to_pylist()]]).reshape(-1, 3)
        rows = rows[_labelled(labels, rows[:, 0]) != rows[:, 2]][:, :2]
        return in_pages(rows, rows[:, 1])

    def by_greater(pairs: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x, "<i8") for x in pairs.column("others").to_pylist()]).reshape(-1, 2)
        rows = rows[np.lexsort((rows[:, 0], rows[:, 1]))]
        begin = np.flatnonzero(np.concatenate(([True], rows[1:, 1] != rows[:-1, 1])))
        lesser = pa.ListArray.from_arrays(pa.array([*begin.tolist(), len(rows)], pa.int32()), pa.array(rows[:, 0]))
        return pa.table({"b": pa.array(rows[begin, 1]), "lesser": lesser})

    labels = found.select("node", "component").mapInArrow(place, "page long, key long, component long").groupBy("page")
    moved = "page long, others binary"
    known = stars.filter("others IS NOT NULL").select("page", "others").groupBy("page").cogroup(labels).applyInArrow(learn_greater, moved)
    apart = known.groupBy("page").cogroup(labels).applyInArrow(learn_lesser, moved)
    return apart.groupBy("page").applyInArrow(by_greater, "b long, lesser array<long>")


def in_groups(wanted: DataFrame) -> DataFrame:
    """wanted (b, lesser) with the group of each b as place: what the first and last of the lesser ones connect is a group."""
    ends = F.explode(F.array(F.element_at("lesser", 1), F.element_at("lesser", -1)))
    groups = components(wanted.select(ends.alias("a"), "b"))
    return wanted.join(groups.select(F.col("node").alias("b"), F.col("component").alias("place")), "b")


def members(wanted: DataFrame, place: str) -> DataFrame:
    """(place, class, pairs): the classes of wanted (b, lesser) in each place, once each, or twice if also as b. With each b the number of its pairs."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out = []
            for at, b, lesser in zip(*(batch.column(c).to_pylist() for c in (place, "b", "lesser"))):
                out.append((at, b, len(lesser)))
                new = [(at, a) for a in lesser if (at, a) not in seen]
                out += [(*x, 0) for x in new]
                seen.add((at, b))
                seen.update(new)
            rows = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], names=[place, "class", "pairs"])

    return wanted.select(place, "b", "lesser").repartition(place).mapInArrow(listed, f"{place} long, class long, pairs long")


def in_rooms(wanted: DataFrame, sizes: DataFrame, n: int) -> DataFrame:
    """wanted (b, lesser, place) as (room, b, lesser). sizes: (class, size). A place of many sets or pairs is cut into rooms by
    both sides, as many as the sets of one side fill; small places share n rooms."""
    loads = members(wanted, "place").join(sizes, "class").groupBy("place").agg(F.sum("size").alias("size"), F.sum("pairs").alias("pairs"))
    cuts = F.greatest(F.ceil(F.col("size") * 8 / ROOM_BYTES), F.ceil(F.sqrt(F.col("pairs") / ROOM_PAIRS)))
    dealt = wanted.join(loads.select("place", cuts.cast("long").alias("cuts")), "place")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b, lesser, place, cuts in zip(*(batch.column(c).to_pylist() for c in ("b", "lesser", "place", "cuts"))):
                home = int(_pages_of(np.array([place]), n)[0])
                if cuts == 1:
                    out.append((home, b, lesser))
                    continue
                lesser = np.array(lesser, dtype=np.int64)
                column = _pages_of(lesser, cuts)
                line = int(_pages_of(np.array([~b]), cuts)[0])
                for x in np.unique(column).tolist():
                    room = int(mixed(np.array([place, line * cuts + x + 1]).view(np.uint64)).sum(dtype=np.uint64).view(np.int64))
                    out.append((room, b, lesser[column == x].tolist()))
            rooms, greater, lists = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(rooms, pa.int64()), pa.array(greater, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["room", "b", "lesser"])

    return dealt.select("b", "lesser", "place", "cuts").mapInArrow(cut, "room long, b long, lesser array<long>")


def _read_lists(percent: int, most: int, n: int):
    def read(table: pa.Table) -> pa.Table:
        """Pairs of all lists of a page, and in how many of its lists each is; of a list that is too long, pairs with its
        least set and the entries."""
        entries = np.concatenate([np.frombuffer(x, dtype=ENTRY) for x in table.column("values").to_pylist()])
        entries = entries[np.lexsort((entries["at"], entries["list"]))]
        begin = np.flatnonzero(np.concatenate(([True], entries["list"][1:] != entries["list"][:-1])))
        end = np.concatenate((begin[1:], [len(entries)]))
        width = end - begin
        read = entries[np.repeat((width > 1) & (width <= most), width)]
        one, two = read_lists(read, percent)
        keys, at = np.unique(read["key"], return_inverse=True)
        low, high = np.minimum(at[one], at[two]), np.maximum(at[one], at[two])
        both, first, shared = np.unique(low * max(len(keys), 1) + high, return_index=True, return_counts=True)
        need = np.minimum(read["need"][one], read["need"][two])[first]
        # A pair that shares a segment is one to compare, whatever else it shares.
        segment = np.isin(both, np.unique((low * max(len(keys), 1) + high)[read["at"][one] < 0]))
        pairs = [_pairs(keys[both // max(len(keys), 1)], keys[both % max(len(keys), 1)], shared, np.where(segment, 1, need))]
        out = []
        for x, y in zip(begin[width > most].tolist(), end[width > most].tolist()):
            listed = entries[x:y]
            others = listed["key"][listed["key"] != listed["key"].min()]
            ones = np.ones(len(others))
            pairs.append(_pairs(np.full(len(others), listed["key"].min()), others, ones, ones))
            bits = listed["bits"].view(np.int64).reshape(-1, _BITS // 64)
            none = pa.nulls(len(listed), pa.int64())
            body = pa.nulls(len(listed), pa.binary())
            out.append(pa.table({"kind": pa.array(np.ones(len(listed), dtype=np.int32)), "chunk": none, "page": none, "keys": body, "values": body, "a": listed["key"], "list": listed["list"].view(np.int64), "size": listed["size"], **{f"b{i}": np.ascontiguousarray(bits[:, i]) for i in range(4)}}))
        return pa.concat_tables([_pair_pages(table.column("page")[0].as_py(), np.concatenate(pairs), n), *out])

    return read


class _Links:
    """Comparisons of a room. Answers that follow from others are not computed. parent: of sets the component they are in already."""

    def __init__(self, sets: dict[int, np.ndarray], percent: int, parent: dict[int, int]):
        self.sets, self.percent = sets, percent
        self.parent = parent
        self.known: dict[tuple[int, int], int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def shared(self, a: int, b: int) -> int:
        pair = (min(a, b), max(a, b))
        if pair not in self.known:
            self.known[pair] = len(np.intersect1d(self.sets[a], self.sets[b], assume_unique=True))
        return self.known[pair]

    def enough(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (len(self.sets[a]) + len(self.sets[b]) - shared)

    def answer(self, key: int, candidates: list[int]) -> list[tuple[int, int]]:
        """Links of `key` with its candidates that connect what isn't connected by links found before."""
        out: list[tuple[int, int]] = []
        lead = candidates[0]
        for other in candidates:
            if self.root(key) == self.root(other):
                continue
            if other == lead:
                linked = self.enough(self.shared(key, lead), key, lead)
            else:
                # What the lead shares with the other, less what the lead has alone, more what this set has alone.
                through, mine = self.shared(lead, other), self.shared(key, lead)
                if self.enough(max(0, through - (len(self.sets[lead]) - mine)), key, other):
                    linked = True
                elif not self.enough(min(through + len(self.sets[key]) - mine, len(self.sets[key]), len(self.sets[other])), key, other):
                    linked = False
                else:
                    linked = self.enough(self.shared(key, other), key, other)
            if linked:
                self.parent[self.root(key)] = self.root(other)
                out.append((key, other))
        return out


def _named(docs: DataFrame, key: str, text: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Rows (key, text, chunk) with a name: chunk and name together tell a row from all that differ in key or text."""
    rows, n = chunked(docs, key, text, chunk_bytes)
    return rows.withColumn("name", _name("key", "text")), n


def _name(key: Column | str, text: Column | str) -> Column:
    return F.xxhash64(F.lit("name"), text, key)


def _join(docs: DataFrame, key: str, text: str, shingle: int, percent: int, lower: bool, most: int, chunk_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Rows (key, chunk, name, n, one, two), a set's classes (n, one, two, class, key, chunk, name), links (a, b) that
    connect them, and the number of chunks. A class is led by one row; key is the least of its rows. All steps in Python
    have run when it returns: it is called where batches are small."""
    rows, n = _named(docs, key, text, chunk_bytes)

    def name_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in pieces(batches):
            sets = Sets(Words(run, lower), run.rows, shingle)
            one, two = sets.names()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "chunk", "name")], pa.array(sets.size, pa.int64()), pa.array(one), pa.array(two)], names=["key", "chunk", "name", "n", "one", "two"])

    named = saved(rows.mapInArrow(name_sets, "key long, chunk long, name long, n long, one long, two long"))
    classes = named.filter("n > 0").groupBy("n", "one", "two").agg(F.min(F.struct("name", "chunk")).alias("lead"), F.min("key").alias("key"))
    # The number is given once: from here on it is read from where it was written.
    classes = saved(classes.select("n", "one", "two", F.monotonically_increasing_id().alias("class"), "key", "lead.chunk", "lead.name"))
    # Equal rows, however many, go to their chunk once a task; there one is left.
    once = lambda batches: _once(batches, "chunk", "name")
    texts = rows.filter("text <> ''").select("chunk", "name", "text").mapInArrow(once, "chunk long, name long, text string")
    by_chunk = texts.repartition(n, "chunk").dropDuplicates(["chunk", "name"]).groupBy("chunk")
    # What a chunk is told: the rows that lead classes at level -1, answers at level 0.
    chosen = classes.select("chunk", F.col("class").alias("page"), F.lit(-1).alias("level"), _bytes("name").alias("answer"))

    def looked(table: pa.Table, answers: pa.Table) -> list[_Looked]:
        return [_Looked(keys, sets, percent) for keys, sets in _texts(table, answers, shingle, lower)]

    def shingles_of(parts: list[_Looked]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(np.concatenate([p.hashes for p in parts]) if parts else np.zeros(0, np.uint64), return_counts=True)
        order = paged(keys, n)
        return keys[order], counts[order].astype(np.uint32)

    def ask(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        return write_pages(chunk, *shingles_of(looked(table, answers)), n)

    def enter(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        parts = looked(table, answers)
        keys, _ = shingles_of(parts)
        code = read_answers(answers, 0)
        order = np.argsort(keys)
        keys, code = keys[order], code[order]
        out = [np.empty(0, dtype=ENTRY)]
        for part in parts:
            mine = code[np.searchsorted(keys, part.hashes)] if len(keys) else np.zeros(0, np.uint8)
            long = np.bincount(part.row[mine == _MANY], minlength=len(part.keys))
            out.append(part.entries(mine == _SOME, np.maximum(1, spare(part.sets.size, percent) + 1 - long)))
            least = spare(least_shared(part.sets.size, percent), percent) + 1
            out.append(part.segments(np.flatnonzero(long >= least), percent))
        entries = np.concatenate(out)
        entries = entries[paged(entries["list"], n)]
        return write_pages(chunk, np.ascontiguousarray(entries["list"]), entries, n).drop_columns(["keys"])

    asked = by_chunk.cogroup(chosen.groupBy("chunk")).applyInArrow(ask, PAGE)
    codes = answered(asked, 0, np.uint32, _how_often(most))
    entered = by_chunk.cogroup(codes.unionByName(chosen).groupBy("chunk")).applyInArrow(enter, "chunk long, page long, values binary")
    read = saved(entered.groupBy("page").applyInArrow(_read_lists(percent, most, n), READ))
    stars = saved(read.filter("kind = 0").select("page", "values").groupBy("page").applyInArrow(_add_pairs, STAR))

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in pieces(_once(batches, "class")):
            sets = Sets(Words(run, lower), run.rows, shingle)
            bodies = [sets.hashes[x:y].tobytes() for x, y in zip(sets.first[:-1].tolist(), sets.first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(bodies, pa.binary())], names=["class", "body"])

    def compare(table: pa.Table) -> pa.Table:
        """Compare the pairs of a room (class and lesser) by the sets in it (class, component and body)."""
        sets, parent, wanted = {}, {}, {}
        for k, component, body, lesser in zip(*(table.column(c).to_pylist() for c in ("class", "component", "body", "lesser"))):
            if body is None:
                wanted.setdefault(k, []).extend(lesser)
            else:
                sets[k], parent[k] = np.frombuffer(body, dtype=np.uint64), component
        links = _Links(sets, percent, parent)
        out = [link for k in sorted(wanted) for link in links.answer(k, sorted(wanted[k]))]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    def linked(wanted: DataFrame, found: DataFrame | None = None) -> DataFrame:
        """Links (a, b) that connect the pairs of wanted (b, lesser, place) as far as they can be and found (node, component) does not. They are compared in rooms; a
        set goes to a room once."""
        wanted = saved(in_rooms(wanted, classes.select("class", F.col("n").alias("size")), n))
        needs = saved(members(wanted, "room").select("room", "class").distinct())
        sites = saved(needs.select("class").distinct().join(classes.select("class", "chunk", "name"), "class"))
        # A few are sent to where the texts are, so that no text is shuffled; else texts and names meet by hash.
        few = sites.count() <= FEW_KEYS
        bodies = rows.join(F.broadcast(sites), ["chunk", "name"]) if few else texts.join(sites, ["chunk", "name"])
        bodies = bodies.select("class", "text").mapInArrow(make_sets, "class long, body binary")
        sent = needs.join(bodies.dropDuplicates(["class"]), "class")
        if found is None:
            sent = sent.withColumn("component", F.col("class"))
        else:
            sent = sent.join(found.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        sent = sent.select("room", "class", "component", "body", F.lit(None).cast("array<long>").alias("lesser"))
        asked = wanted.select("room", F.col("b").alias("class"), F.lit(None).cast("long").alias("component"), F.lit(None).cast("binary").alias("body"), "lesser")
        return saved(sent.unionByName(asked).groupBy("room").applyInArrow(compare, "a long, b long"))

    # Each set is compared with the least of its candidates, then only with those that this leaves unconnected: a group of
    # copies of each other costs a pair each.
    links = linked(stars.filter("a IS NOT NULL").select("b", F.array("a").alias("lesser"), F.col("a").alias("place")))
    found = components(links)
    left = saved(unconnected(stars, found, n))
    if not left.isEmpty():
        links = links.unionByName(linked(in_groups(left), found))
        found = components(links)
    # Of lists too long to be read, what their least sets have left unconnected.
    rest = _unconnected_of_lists(read.filter("kind = 1"), found, percent).groupBy("b").agg(F.collect_set("a").alias("all"))
    rest = rest.join(left, "b", "left").select("b", F.array_sort(F.array_except("all", F.coalesce("lesser", F.array().cast("array<long>")))).alias("lesser"))
    rest = saved(rest.filter("size(lesser) > 0"))
    if not rest.isEmpty():
        links = links.unionByName(linked(in_groups(rest), found))
    return named, classes, links, n


def _same_key(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of classes that hold rows of one key: each with the least of them."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("n", "one", "two") for f in (F.min, F.max)]
    several = named.filter("n > 0 AND key IS NOT NULL").groupBy("key").agg(*ends)
    several = several.filter("min_n < max_n OR min_one < max_one OR min_two < max_two").select("key")
    held = named.filter("n > 0").join(several, "key").join(classes.select("n", "one", "two", "class"), ["n", "one", "two"])
    held = saved(held.select("key", "class").distinct())
    return held.groupBy("key").agg(F.min("class").alias("a")).join(held.withColumnRenamed("class", "b"), "key").filter("a <> b").select("a", "b")


def _in_components(named: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(n, one, two, component, least): the component of each class, and the least key in it."""
    found = components(links).toDF("class", "component")
    placed = classes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = placed.groupBy("component").agg(F.min("key").alias("least"))
    return placed.select("n", "one", "two", "component").join(least, "component")


def join_sets(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 90, lower: bool = True, most: int = MOST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_shingles, component_id) of every row: texts are linked if their sets share `percent` or more of their union,
    and a component is all that links reach, named by its least key.

    Sets are of distinct runs of `shingle` words, A-Z in lower case; a text of fewer words is one run as a whole. An
    empty or null text has no shingles, links with nothing and keeps its own key. Equal sets are linked. Keys are integers.
    Rows with a key in common are one document: what links to any of their texts is connected. A row with a null key is
    linked by its text, and so connects others; its own component is null. Shingles are compared by 64-bit hashes.
    """
    with small_batches(docs.sparkSession):
        named, classes, links, _ = _join(docs, key, text, shingle, percent, lower, most, chunk_bytes)
    placed = _in_components(named, classes, links.unionByName(_same_key(named, classes)))
    out = named.join(placed, ["n", "one", "two"], "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("key").isNotNull(), F.coalesce("least", "key")).alias("component_id"))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, lower: bool = True, most: int = MOST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of docs without near duplicates: of all that links reach the one with the least key, one without a key last.

    Links are those of `join_sets`, but of rows and not of documents: a row stays or goes by its own text, whatever other
    rows have its key. Of equal rows, and of rows with one key and set, one stays. A row without shingles goes only where another equals it in key and text.
    """
    with small_batches(docs.sparkSession):
        named, classes, links, n = _join(docs, key, text, shingle, percent, lower, most, chunk_bytes)
    placed = _in_components(named, classes, links).select("n", "one", "two", "component")
    order = F.struct(F.col("key").isNull(), "key", "name", "chunk")
    first = named.join(placed, ["n", "one", "two"]).groupBy("component").agg(F.min(order).alias("first"))
    stay = first.select("first.chunk", "first.name").unionByName(named.filter("n = 0").select("chunk", "name"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.pmod(F.xxhash64(key, body), F.lit(n)).alias("chunk"), _name(key, body).alias("name"))
    return rows.join(stay, ["chunk", "name"], "left_semi").dropDuplicates(["chunk", "name"]).select("row.*")


def _bytes(column: str):
    """A long as its eight bytes, the lowest first."""
    parts = [F.unhex(F.lpad(F.hex(F.shiftrightunsigned(F.col(column), 8 * i).bitwiseAND(255)), 2, "0")) for i in range(8)]
    return F.concat(*parts)


def _unconnected_of_lists(entries: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs in the same long list, in different components so far, that sizes and bitmaps allow to be linked.

    In each list the component with most entries stays on one side, so a list that is connected costs nothing.
    """
    at = found.select(F.col("node").alias("a"), "component")
    entries = entries.select("a", "list", "size", *[f"b{i}" for i in range(4)]).join(at, "a", "left").withColumn("component", F.coalesce("component", "a"))
    counts = entries.groupBy("list", "component").agg(F.count(F.lit(1)).alias("entries"))
    largest = counts.groupBy("list").agg(F.max(F.struct("entries", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"))
    open_lists = largest.filter("parts > 1").select("list", F.col("largest.component").alias("largest"))
    entries = entries.join(open_lists, "list")
    few = entries.filter("component <> largest").drop("largest").toDF(*[f"x_{c}" if c != "list" else c for c in entries.drop("largest").columns])
    differ = sum((F.bit_count(F.col(f"b{i}").bitwiseXOR(F.col(f"x_b{i}"))) for i in range(4)), F.lit(0))
    size = F.col("size") + F.col("x_size")
    near = differ <= F.floor(size * (100 - percent) / (100 + percent))
    pairs = few.join(entries, "list").filter((F.col("component") != F.col("x_component")) & near)
    return pairs.select(F.least("a", "x_a").alias("a"), F.greatest("a", "x_a").alias("b"))
