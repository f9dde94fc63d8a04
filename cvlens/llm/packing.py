"""Best-fit packing of documents into sequences of a fixed length, by bin completion.

Documents are encoded, given an end id, and cut into pieces of ``capacity``
tokens only where they are longer. Full pieces are sequences already. The rest
is packed by bin completion: take the largest piece that is left, enumerate the
undominated fillings of the room beside it, best fit first, and branch on them.
The best-fit-decreasing packing is the first incumbent; a branch is cut when
its waste so far passes what any better packing may waste
(``(incumbent - 1) * capacity - total``). All undominated fillings are
enumerated, lazily; the search ends when the incumbent meets the bound
``ceil(total / capacity)``, when nothing is left to try, or when its budget of
steps is spent. The best packing found then stands: no piece is ever left out,
which each group checks before it returns.

Spark deals the pieces into groups of about ``group_tokens`` tokens by a hash
of their place, each group is packed in one task, and the sequences with room
left are opened again and packed together in a second round, so the loss at
the groups' edges is not paid once a group.

Null texts count as empty; an empty text is its end id. Repeated rows and equal
identifiers are separate documents. An empty table packs into nothing. Very
long texts are cut into pieces like any others. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import written
from cvlens.llm.word_tokens import with_end, word_tokenizer

CAPACITY = 4096
GROUP_TOKENS = 8 << 20
# Fillings of up to so many pieces beside the largest come before longer ones.
SHORT = 4
# Budget of the search of one group: so many steps (a sequence filled, or a look for pieces of one sum), and so many a sequence.
STEPS = 20_000
STEPS_EACH = 160


class _Shelf:
    """The pieces that are left, by length; a bit for each length at hand."""

    def __init__(self, lengths, capacity: int):
        self.capacity = capacity
        self.count = [0] * (capacity + 1)
        self.bits = self.mirror = 0  # bit x, and bit capacity - x, for length x
        for x in lengths:
            self.put(x)

    def put(self, x: int) -> None:
        self.count[x] += 1
        if self.count[x] == 1:
            self.bits |= 1 << x
            self.mirror |= 1 << (self.capacity - x)

    def take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            self.bits &= ~(1 << x)
            self.mirror &= ~(1 << (self.capacity - x))

    def upto(self, x: int) -> int:
        """The largest length at hand of at most ``x``, or 0."""
        return (self.bits & ((1 << (x + 1)) - 1)).bit_length() - 1 if x > 0 and self.bits & ((1 << (x + 1)) - 1) else 0

    def smallest(self) -> int:
        return (self.bits & -self.bits).bit_length() - 1 if self.bits else 0

    def pairs(self, room: int, most: int, free) -> Iterator[tuple[int, int]]:
        """All pairs of lengths at hand with the sum ``room``, none above ``most``, the largest first."""
        if room < 2:
            return
        both = self.bits & (self.mirror >> (self.capacity - room)) & ((1 << (min(most, room - 1) + 1)) - 1)
        while both:
            a = both.bit_length() - 1
            if 2 * a < room:
                return
            if free(a, 0) and (2 * a != room or free(a, 1)) and free(room - a, 0):
                yield a, room - a
            both &= ~(1 << a)


class _Steps:
    """What is left of a search's budget."""

    def __init__(self, n: int):
        self.left = n


def _exact(shelf: _Shelf, total: int, n: int, most: int, used: tuple[int, ...], steps: _Steps) -> Iterator[tuple[int, ...]]:
    """All ways to make up ``total`` with ``n`` more pieces that are left, none above ``most``, the largest first.

    The shelf is only read (``used`` are the pieces already in the filling), so it does not matter whether the
    iterator is ever finished.
    """
    def free(x: int, taken: int) -> bool:
        return shelf.count[x] > taken + used.count(x)

    steps.left -= 1
    if n == 1:
        if 0 < total <= most and free(total, 0):
            yield (total,)
    elif n == 2:
        yield from shelf.pairs(total, most, free)
    else:
        a = shelf.upto(min(total - (n - 1) * shelf.smallest(), most))
        while a and a * n >= total and steps.left > 0:
            if free(a, 0):
                for rest in _exact(shelf, total - a, n - 1, a, (*used, a), steps):
                    yield (a, *rest)
            a = shelf.upto(a - 1)


def _dominated(shelf: _Shelf, filling: tuple[int, ...], waste: int) -> bool:
    """Whether a piece that is left fits into the waste, or in the place of a smaller one of the filling."""
    if not waste:
        return False
    for y in (0, *sorted(set(filling))):
        x = shelf.upto(y + waste)
        while x > y:
            if shelf.count[x] > filling.count(x):
                return True
            x = shelf.upto(x - 1)
    return False


def fillings(shelf: _Shelf, room: int, most_waste: int, steps: _Steps) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room`` that waste at most ``most_waste``, until ``steps`` are spent.

    Least waste first, then the fewest and largest pieces; those of more than ``SHORT`` pieces come after the
    others. One piece that fills the room dominates all else; fillings that leave room for a further piece, or
    for a larger one in the place of one of theirs, are dominated.
    """
    smallest = shelf.smallest()
    if room <= 0 or not smallest or smallest > room:
        if room <= most_waste:
            yield ()
        return
    if shelf.count[room]:
        yield (room,)
        return
    most = room // smallest
    for counts in (range(1, min(SHORT, most) + 1), range(SHORT + 1, most + 1)):
        for waste in range(0, min(most_waste, room - smallest) + 1):
            for n in counts:
                if n * smallest > room - waste:
                    break
                for f in _exact(shelf, room - waste, n, room, (), steps):
                    if not _dominated(shelf, f, waste):
                        yield f
                if steps.left <= 0:
                    return


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Each piece, the largest first, goes where it leaves least room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some sequence has room r
    for x in sorted(lengths, reverse=True):
        fit = rooms >> x
        if fit:
            r = x + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
            bins[b].append(x)
            r -= x
        else:
            b, r = len(bins), capacity - x
            bins.append([x])
        if r:
            by_room.setdefault(r, []).append(b)
            rooms |= 1 << r
    return bins


def complete_bins(lengths: list[int], capacity: int = CAPACITY, step_limit: int | None = None) -> list[list[int]]:
    """Pack ``lengths`` into as few sequences as the search finds; lists of lengths.

    Limited discrepancy search: the first pass takes the first filling everywhere, the next lets one sequence take
    a later one (the last sequences first), and so on until a pass was not held back by its limit. Without a
    ``step_limit`` of its own the search of n sequences has ``STEPS + STEPS_EACH * n`` steps.
    """
    total = sum(lengths)
    bound = -(-total // capacity)
    best = best_fit_decreasing(lengths, capacity)
    if len(best) <= bound:
        return best
    shelf = _Shelf(lengths, capacity)
    steps = _Steps(step_limit or STEPS + STEPS_EACH * len(best))
    late = 0
    while steps.left > 0:
        best, held_back = _search(shelf, best, total, late, steps)
        if len(best) <= bound or not held_back:
            break
        late += 1
    return best


def _search(shelf: _Shelf, best: list[list[int]], total: int, late: int, steps: _Steps) -> tuple[list[list[int]], bool]:
    """(the best packing known, whether ``late`` later choices a path were too few); the shelf is left as it was given."""
    capacity = shelf.capacity
    bound = -(-total // capacity)
    allowed = (len(best) - 1) * capacity - total
    path: list[tuple[int, tuple[int, ...], int, int]] = []  # largest, filling, waste and later choices before it
    levels: list[list] = []  # largest, its fillings, how many were taken
    waste = turns = 0
    held_back = False

    def descend() -> None:
        top = shelf.bits.bit_length() - 1
        shelf.take(top)
        levels.append([top, fillings(shelf, capacity - top, allowed - waste, steps), 0])

    def undo() -> tuple[int, int]:
        _, filling, waste_before, turns_before = path.pop()
        for x in filling:
            shelf.put(x)
        return waste_before, turns_before

    descend()
    while levels:
        if len(path) == len(levels):  # come back from below
            waste, turns = undo()
        top, options, taken = levels[-1]
        filling = next(options, None) if steps.left > 0 else None
        if filling is not None and taken and turns >= late:
            held_back, filling = True, None
        if filling is None:
            shelf.put(top)
            levels.pop()
            continue
        levels[-1][2] += 1
        more = capacity - top - sum(filling)
        if waste + more > allowed:
            continue
        steps.left -= 1
        path.append((top, filling, waste, turns))
        for x in filling:
            shelf.take(x)
        waste += more
        turns += taken > 0
        if shelf.bits:
            descend()
            continue
        best = [[t, *f] for t, f, _, _ in path]
        allowed = (len(best) - 1) * capacity - total
        if len(best) <= bound:
            break
    while levels:  # the bound was met: give back what the path holds
        if len(path) == len(levels):
            undo()
        shelf.put(levels.pop()[0])
    return best, held_back


def _pack_group(capacity: int, step_limit: int | None):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece_key", kind="stable")
        lengths = pdf["length"].to_numpy()
        at: dict[int, list[int]] = {}
        for i in range(len(lengths) - 1, -1, -1):
            at.setdefault(int(lengths[i]), []).append(i)
        number, offset, room = (np.full(len(pdf), -1, np.int64) for _ in range(3))
        for b, members in enumerate(complete_bins([int(x) for x in lengths], capacity, step_limit)):
            place = 0
            own = [at[x].pop() for x in members]
            for i in own:
                number[i], offset[i] = b, place
                place += int(lengths[i])
            room[own] = capacity - place
            if place > capacity:
                raise RuntimeError(f"sequence {b} holds {place} tokens")
        if (number < 0).any() or any(at.values()):
            raise RuntimeError("packing did not place every piece once")
        return pd.DataFrame({"piece_key": pdf["piece_key"], "length": lengths, "grp": pdf["grp"], "bin": number,
                             "offset": offset, "room": room})
    return pack


_PACKED = "piece_key long, length long, grp long, bin long, offset long, room long"


def _round(pieces: DataFrame, n_groups: int, capacity: int, step_limit: int | None, salt: int) -> DataFrame:
    grp = F.pmod(F.xxhash64(F.lit(salt), "piece_key"), F.lit(n_groups))
    return (pieces.select("piece_key", "length").withColumn("grp", grp)
            .groupBy("grp").applyInPandas(_pack_group(capacity, step_limit), _PACKED))


def pack_lengths(pieces: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS,
                 step_limit: int | None = None) -> DataFrame:
    """(piece_key, sequence_id, offset) for ``pieces`` (piece_key long, unique and not negative; length long).

    Sequences of one full piece take the piece's key as their number; packed
    ones have negative numbers.
    """
    full = pieces.filter(F.col("length") == capacity).select("piece_key", F.col("piece_key").alias("sequence_id"),
                                                             F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity)
    done, left = [], rest
    for turn in (0, 1):
        tokens = left.select(F.sum("length")).first()[0]
        if not tokens:
            break
        n_groups = -(-int(tokens) // group_tokens)
        packed = written(_round(left, n_groups, capacity, step_limit, turn), "packed")
        last = turn == 1 or n_groups == 1
        closed = packed if last else packed.filter("room = 0")
        done.append(closed.select("piece_key", (-1 - (((F.lit(turn) + F.col("grp") * 2) * F.lit(1 << 24)) + F.col("bin"))).alias("sequence_id"),
                                  "offset"))
        if last:
            break
        left = packed.filter("room > 0")
    for d in done:
        full = full.unionByName(d)
    return full


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(piece_key, doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    def cut(batches):
        import pyarrow as pa
        tok = word_tokenizer(tokenizer)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                doc_ids, texts = (c.to_pylist() for c in b.slice(lo, 1024).columns)
                flat, counts = with_end(*tok.encode(texts), end_id)
                raw = flat.astype("<u4").tobytes()
                n = -(-counts // capacity)
                of = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(counts[of] - start, capacity)
                a = (np.cumsum(counts) - counts)[of] + start
                cuts = [raw[4 * x:4 * (x + y)] for x, y in zip(a.tolist(), length.tolist())]
                columns = [pa.array([doc_ids[i] for i in of], pa.int64()), pa.array(piece.astype(np.int32)), pa.array(start),
                           pa.array(length), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(cuts, pa.binary())] * with_ids,
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(cut, schema).withColumn("piece_key", F.monotonically_increasing_id()))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    pieces = written(cut_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return pieces.join(pack_lengths(pieces, capacity, group_tokens), "piece_key").drop("piece_key")
