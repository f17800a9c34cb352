"""Lowest-rank merging: of one long list of symbols in time n log n, and of many short ones at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Longer chunks are merged one by one with a heap, which is faster for them.
ROUND_BYTES = 32
# Up to so many merges in order a long chunk is read once for each of them.
FEW_MERGES = 500


def rank_merger():
    """The merging function, for use inside tasks.

    It is made here so that it travels with the task: executors need not have this package.
    """
    from heapq import heapify, heappop, heappush

    def merge(symbols: list, ranks: dict) -> list:
        """While known pairs remain, merge all occurrences of the lowest-ranked one from left to right.

        ``ranks`` maps a pair of symbols to (rank, merged symbol); a rank belongs to one
        pair. A heap holds (rank, place of the left symbol); links lead to the neighbours
        that are left. What is no longer as it was pushed is skipped. Pairs that a merge
        makes wait until all occurrences of its own pair are done.
        """
        symbols = list(symbols)
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        known = ranks.get
        heap = []
        for place, pair in enumerate(zip(symbols, symbols[1:])):
            found = known(pair)
            if found is not None:
                heap.append((found[0], place))
        heapify(heap)
        while heap:
            rank, merged, touched = heap[0][0], None, []
            while heap and heap[0][0] == rank:
                place = heappop(heap)[1]
                right = after[place]
                if symbols[place] is None or right >= size:
                    continue
                found = known((symbols[place], symbols[right]))
                if found is None or found[0] != rank:
                    continue
                merged = found[1]
                symbols[place], symbols[right] = merged, None
                behind = after[place] = after[right]
                if behind < size:
                    before[behind] = place
                touched.append(place)
            for place in touched:
                if symbols[place] is None:
                    continue
                for left in (before[place], place):
                    if left >= 0 and after[left] < size:
                        found = known((symbols[left], symbols[after[left]]))
                        if found is not None:
                            heappush(heap, (found[0], left))
        return [s for s in symbols if s is not None]

    return merge


def rounds_merger(byte_ids: tuple[int, ...], merges: pa.Table, in_order: bool):
    """A function from chunks to their token strings, for use inside tasks.

    ``merges``: (left_id, right_id, merged_id, rank). All short chunks take their lowest-ranked
    merge in one round, all its occurrences from left to right, until none has any; long ones
    are merged by `rank_merger`.
    """
    ranked = merges.sort_by("rank")
    left, right, result, rank = (ranked[c].to_numpy().astype(np.int64) for c in ("left_id", "right_id", "merged_id", "rank"))
    # More than any id; a first key that no pair has, so that there always is one.
    base, never = 1 << 21, np.iinfo(np.int64).max
    keys, first = np.unique(left * base + right, return_index=True)
    keys = np.append(-1, keys)
    result, rank = np.append(0, result[first]), np.append(never, rank[first])
    start_ids, short_bytes, few = np.array(byte_ids, np.int64), ROUND_BYTES, FEW_MERGES
    merge_one, known = rank_merger(), {}

    def chars(ids: np.ndarray) -> bytes:
        points = ids + 1
        points[points >= 0xD800] += 0x800
        return points.astype("<u4").tobytes().decode("utf-32-le").encode()

    def long(data: np.ndarray) -> list | np.ndarray:
        if in_order and len(keys) <= few + 1:
            text = chars(start_ids[data]).decode()
            for i in np.argsort(rank[1:], kind="stable") + 1:
                l, r, one = (chars(np.array([x])).decode() for x in (*divmod(keys[i], base), result[i]))
                text = text.replace(l + r, one)
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            return points - 1 - 0x800 * (points >= 0xD800)
        if not known:
            known.update(zip(zip((keys[1:] // base).tolist(), (keys[1:] % base).tolist()), zip(rank[1:].tolist(), result[1:].tolist())))
        return np.array(merge_one(start_ids[data].tolist(), known), np.int64)

    def merge(chunks: pa.Array) -> pa.Array:
        size = len(chunks)
        texts = chunks.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + size + 1] if size else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets)
        offsets = offsets - offsets[0]
        word = np.repeat(np.arange(size), sizes)
        is_long = sizes > short_bytes
        ended = [(np.full(len(ids), n), ids) for n in np.flatnonzero(is_long) for ids in [long(data[offsets[n] : offsets[n + 1]])]]
        mine = ~is_long[word]
        ids, word = start_ids[data[mine]], word[mine]
        while len(ids):
            same = np.append(word[1:] == word[:-1], False)
            key = ids * base
            key[:-1] += ids[1:]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            ranks = np.where(same & (keys[at] == key), rank[at], never)
            begins = np.append(0, np.flatnonzero(~same)[:-1] + 1)
            lowest = np.repeat(np.minimum.reduceat(ranks, begins), np.diff(np.append(begins, len(ids))))
            live = lowest < never
            ended.append((word[~live], ids[~live]))
            hit = np.flatnonzero(live & (ranks == lowest))
            # Where a token is merged with its like, every other place of a row of them.
            lone = np.append(True, np.diff(hit) != 1)[: len(hit)]
            if not lone.all():
                number = np.arange(len(hit))
                hit = hit[(number - np.maximum.accumulate(np.where(lone, number, 0))) % 2 == 0]
            ids[hit] = result[at[hit]]
            live[hit + 1] = False
            ids, word = ids[live], word[live]
        word = np.concatenate([w for w, _ in ended]) if ended else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in ended]) if ended else np.zeros(0, np.int64)
        ids = ids[np.argsort(word, kind="stable")]
        wide = 1 + (ids >= 0x7F).astype(np.int64) + (ids >= 0x7FF) + (ids + 1 + 0x800 * (ids >= 0xD7FF) >= 0x10000)
        ends = np.append(0, np.cumsum(wide))[np.append(0, np.cumsum(np.bincount(word, minlength=size)))]
        built = pa.LargeStringArray.from_buffers(size, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(chars(ids)))
        return pc.if_else(chunks.is_valid(), built, pa.scalar(None, pa.large_string())).cast(pa.string())

    return merge
