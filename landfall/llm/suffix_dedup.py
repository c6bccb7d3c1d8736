"""Exact removal of long repeats, decided by suffix arrays.

A byte goes if it lies in a string of `length` bytes that also starts earlier: in a
document with a smaller id, or earlier in the same document. All of the input counts.

1. Anchors. In every window of `length` bytes the K-byte string with the smallest hash is
   its anchor, so equal windows have equal anchors at equal places. Blocks of documents
   tell buckets the fingerprints of their anchors and learn which occur more than once;
   all other windows are unique.
2. Regions. A repeated anchor stands with the text of the windows that it serves. Within a
   block, equal regions collapse to the earliest; the others are repeats throughout.
3. Suffix arrays. Regions with equal anchors meet in one bucket. One suffix array of the
   texts from the anchors on and one of the texts before them, read backwards, sort the
   regions both ways; from the common prefixes of neighbours follows which windows are
   equal, and each but the earliest is a repeat. The arrays are built by grouping suffixes
   on their Lyndon prefixes (suffix_array.py), over strings whose symbols are SYMBOL bytes.
4. A very frequent anchor is dealt out over several buckets by its regions' hash first.
   What survives there is dealt again by the hash of the windows, where equal ones meet.
5. Repeats go back to the blocks, where each document's runs are merged and cut out.

Null texts count as empty. Null ids come after all others, ordered by their texts' hash.
Rows with one id are ordered by their texts' hash; if their texts are equal as well they
are one document written twice, and neither repeats the other. Short texts stay whole.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from landfall.llm.blocks import (
    blocked, ddl, dealt, packs, read_pack, squeezed, unsqueezed)
from landfall.llm.suffix_array import suffix_array
from landfall.llm.text import map_rows, mix, to_bytes

K = 32
SYMBOL = 34
LAST_ID = 2**63 - 1
#: Anchors with more occurrences are dealt over several buckets.
HOT = 4096
#: Regions that a task holds for a block, fingerprints before it sends them on, bytes of
#: regions in one suffix array.
HELD, FINGERPRINTS, ARRAY_BYTES = 150_000, 1 << 20, 16 << 20

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0x27D4EB2F165667C5)]


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of the anchors of a text."""
    n = len(raw)
    if n < length:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    words = np.ndarray((n - 7,), np.uint64, raw, 0, (1,))
    m = n - K + 1
    h = words[:m] * _C[0]
    for k in (1, 2, 3):
        h ^= h >> np.uint64(31)
        h += words[8 * k:8 * k + m]
        h *= _C[k]
    h = mix(h)
    # The leftmost of the smallest hashes wins: the place is the low half of the key.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    width, span = 1, length - K + 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[:width - span], key[span - width:])
    place = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return h[at], at, first, last


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _by_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def _hashed(blocks: DataFrame, length: int) -> DataFrame:
    """(block, hashes, counts): the anchors that a task sees of a block, and how often."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def sent() -> Iterator[tuple]:
            for block, found in held.items():
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                yield block, hashes.tobytes(), counts.astype(np.uint32).tobytes()
            held.clear()

        for r in records:
            found = anchors(to_bytes(r["text"]), length)[0]
            if len(found):
                held.setdefault(r["block"], []).append(found)
                size += len(found)
            if size > FINGERPRINTS:
                yield from sent()
                size = 0
        yield from sent()

    return map_rows(blocks, "block long, hashes binary, counts binary", rows)


def _asked(blocks: DataFrame, length: int, buckets: int, tasks: int) -> DataFrame:
    """(bucket, block, prints, counts): fingerprints of a block's anchors, and how many.

    The hashes of a block are gathered first. If its documents are scattered over many
    tasks, each would otherwise put a question of its own to every bucket.
    """

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        block, size = None, 0

        def sent() -> Iterator[tuple]:
            known, where = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(where, np.concatenate(counts)).astype(np.uint32)
            bucket = _by_bucket(known, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.unique(bucket).tolist():
                part = order[edges[b]:edges[b + 1]]
                yield b, block, _fingerprint(known[part]).tobytes(), total[part].tobytes()
            hashes.clear()
            counts.clear()

        for r in records:
            if hashes and (r["block"] != block or size > FINGERPRINTS):
                yield from sent()
                size = 0
            block = r["block"]
            hashes.append(np.frombuffer(r["hashes"], np.uint64))
            counts.append(np.frombuffer(r["counts"], np.uint32))
            size += len(hashes[-1])
        if hashes:
            yield from sent()

    return map_rows(dealt(_hashed(blocks, length), tasks, "block"),
                    "bucket int, block long, prints binary, counts binary", rows)


def _repeated(asked: DataFrame, tasks: int) -> DataFrame:
    """(block, bucket, prints, powers): repeated fingerprints of the block, log2 of how many."""

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def told(bucket: int) -> Iterator[tuple]:
            prints = np.concatenate([p for _, p, _ in held])
            known, where = np.unique(prints, return_inverse=True)
            total = np.bincount(where, np.concatenate([c for _, _, c in held]))
            at = 0
            for block, p, _ in held:
                t = total[where[at:at + len(p)]]
                at += len(p)
                if (more := t > 1).any():
                    yield (block, bucket, p[more].tobytes(),
                           np.log2(t[more]).astype(np.uint8).tobytes())
            held.clear()

        bucket = None
        for r in records:
            if held and r["bucket"] != bucket:
                yield from told(bucket)
            bucket = r["bucket"]
            held.append((r["block"], np.frombuffer(r["prints"], np.uint32),
                         np.frombuffer(r["counts"], np.uint32)))
        if held:
            yield from told(bucket)

    return map_rows(dealt(asked, tasks, "bucket"),
                    "block long, bucket int, prints binary, powers binary", rows)


# What goes to the buckets: regions (kind 0) or the repeats found so far (kind 1).
_SENT = "bucket int, kind int, block long, data binary"
_SPAN = np.dtype([("id", "<i8"), ("mark", "<i8"), ("begin", "<i8"), ("end", "<i8")])


def mark(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _home(region: tuple, buckets: int, salt: int) -> int:
    """The bucket of a region: by its anchor and, for frequent ones, the salt."""
    return (region[0] + salt * 0x9E3779B97F4A7C15) % 2**64 % buckets


def _lots(power: int) -> int:
    return max(1, (1 << power) // HOT)


class _Outbox:
    """Gathers spans by block and regions by bucket, and packs them into rows."""

    def __init__(self, buckets: int):
        self.buckets, self.spans, self.regions, self.size = buckets, {}, {}, 0

    def span(self, block: int, *values: int) -> None:
        self.spans.setdefault(block, []).append(values)
        self.size += 50

    def region(self, bucket: int, region: tuple) -> None:
        self.regions.setdefault(bucket, []).append(region)
        self.size += 300

    def rows(self, least: int = 0) -> Iterator[tuple]:
        if self.size < least:
            return
        for bucket, found in self.regions.items():
            yield bucket, 0, 0, squeezed(pickle.dumps(found, 5))
        for block, found in self.spans.items():
            yield block % self.buckets, 1, block, merged(np.array(found, _SPAN)).tobytes()
        self.spans, self.regions, self.size = {}, {}, 0


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans of each document without overlaps, in order; touching ones become one."""
    spans = np.sort(spans, order=["id", "mark", "begin", "end"])
    if len(spans) < 2:
        return spans
    new = np.append(True, (spans["id"][1:] != spans["id"][:-1])
                    | (spans["mark"][1:] != spans["mark"][:-1]))
    # Ends so far within a document: documents are told apart by a growing offset.
    group = np.cumsum(new) - 1
    room = int(spans["end"].max()) + 2
    reach = np.maximum.accumulate(spans["end"] + group * room) - group * room
    cut = np.append(True, new[1:] | (spans["begin"][1:] > reach[:-1]))
    out = spans[cut]
    out["end"] = reach[np.append(np.flatnonzero(cut)[1:], len(spans)) - 1]
    return out


def _regions(met: DataFrame, length: int, buckets: int) -> DataFrame:
    """Blocks with their repeated fingerprints and packs, to regions and first repeats.

    A region: (anchor hash, id, mark, block, place, first window, text, power, windows):
    places in bytes, windows None for all or those still open as a bit set.
    """

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        out = _Outbox(buckets)
        first: dict[tuple, tuple] = {}
        block, prints, powers = None, {}, {}

        def repeat(region: tuple) -> None:
            h, key, m, its_block, place, begin, text, *_ = region
            out.span(its_block, key, m, begin, begin + len(text))

        def sent() -> Iterator[tuple]:
            for region in first.values():
                lots = _lots(region[7])
                salt = hash_bytes(region[6]) % lots if lots > 1 else 0
                out.region(_home(region, buckets, salt), region)
            first.clear()
            yield from out.rows()

        for r in records:
            if r["block"] != block:
                if block is not None:
                    yield from sent()
                block, prints, powers = r["block"], {}, {}
            if r["kind"] == 0:
                known = np.frombuffer(r["prints"], np.uint32)
                power = np.frombuffer(r["powers"], np.uint8)
                if r["bucket"] in prints:  # a block that several tasks asked for
                    known = np.concatenate([prints[r["bucket"]], known])
                    power = np.concatenate([powers[r["bucket"]], power])
                prints[r["bucket"]], powers[r["bucket"]] = known, power
                continue
            if isinstance(prints, dict):
                prints, powers = _joined(prints, powers)
            for key, _, raw in read_pack(r["pack"]):
                h, place, begin, last = anchors(raw, length)
                if not len(h) or not len(prints):
                    continue
                full = _tagged(_by_bucket(h, buckets), _fingerprint(h))
                at = np.minimum(np.searchsorted(prints, full), len(prints) - 1)
                hit = np.flatnonzero(prints[at] == full)
                if not len(hit):
                    continue
                key, m = LAST_ID if key is None else key, mark(raw)
                for hash_, p, b, e, power in zip(
                        h[hit].tolist(), place[hit].tolist(), begin[hit].tolist(),
                        last[hit].tolist(), powers[at[hit]].tolist(), strict=True):
                    text = raw[b:e + length]
                    region = (hash_, key, m, block, p, b, text, power, None)
                    place_of = (key, m, p)
                    known = first.setdefault((p - b, text), region)
                    if place_of < (its := (known[1], known[2], known[4])):
                        first[p - b, text] = region
                        repeat(known)
                    elif place_of > its:
                        repeat(region)
            if len(first) > HELD:
                yield from sent()
            yield from out.rows(least=8 << 20)
        yield from sent()

    return map_rows(met, _SENT, rows)


def _tagged(bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
    return (bucket.astype(np.uint64) << np.uint64(32)) | prints.astype(np.uint64)


def _joined(prints: dict, powers: dict) -> tuple[np.ndarray, np.ndarray]:
    """All repeated fingerprints of a block, sorted with their buckets, and their powers."""
    if not prints:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    tagged = np.concatenate([_tagged(np.full(len(p), b), p) for b, p in prints.items()])
    order = np.argsort(tagged, kind="stable")
    return tagged[order], np.concatenate(list(powers.values()))[order]


def hash_bytes(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def sorted_texts(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the texts by their first `width` bytes, by the suffix array of them all
    strung together, and the bytes that each shares with the one before it in the order."""
    symbols = -(-width // SYMBOL)
    padded = np.array([t.ljust(symbols * SYMBOL, b"\0") for t in texts],
                      f"S{symbols * SYMBOL}")
    cells = padded.view(f"S{SYMBOL}").reshape(len(texts), symbols)
    _, rank = np.unique(cells.ravel(), return_inverse=True)
    # 0 ends the string and 1 each text, so that no text runs into the next.
    string = np.ones((len(texts), symbols + 1), np.int64)
    string[:, :-1] = rank.reshape(cells.shape) + 2
    found = np.array(suffix_array([*string.ravel().tolist(), 0]))
    order = found[found % (symbols + 1) == 0] // (symbols + 1)
    order = order[order < len(texts)]
    data = padded.view(np.uint8).reshape(len(texts), -1)[order]
    differ = data[1:] != data[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), data.shape[1])
    return order, np.append(0, shared)


def repeated_windows(regions: list[tuple], length: int) -> np.ndarray:
    """For regions in order, the windows that repeat an earlier one, as a bit array.

    Column w stands for the window that begins w - (length - K) bytes from the anchor.
    """
    reach = length - K
    n = len(regions)
    begins = np.array([r[5] - r[4] for r in regions])  # of the first window, from the anchor
    counts = np.array([len(r[6]) - length + 1 for r in regions])
    after, shared_after = sorted_texts([r[6][r[4] - r[5]:] for r in regions], length)
    back, shared_back = sorted_texts([r[6][:r[4] - r[5]][::-1] for r in regions], reach)
    repeats = np.zeros((n, reach + 1), bool)
    windows = None
    if any(r[8] is not None for r in regions):
        every = 2 ** (reach + 1) - 1
        windows = np.array([[(every if r[8] is None else r[8]) >> w & 1
                             for w in range(reach + 1)] for r in regions], bool)
    run_after, run_back = np.empty(n, np.int64), np.empty(n, np.int64)
    for w in range(reach + 1):
        offset = w - reach
        open_ = (begins <= offset) & (offset < begins + counts)
        if windows is not None:
            open_ &= windows[:, w]
        mine = np.flatnonzero(open_)
        if len(mine) < 2:
            continue
        run_after[after] = np.cumsum(shared_after < offset + length)
        run_back[back] = np.cumsum(shared_back < -offset)
        same = run_after[mine] * (n + 1) + run_back[mine]
        _, earliest = np.unique(same, return_index=True)
        again = np.ones(len(mine), bool)
        again[earliest] = False
        repeats[mine[again], w] = True
    return repeats


def _resolved(sent: DataFrame, length: int, buckets: int, tasks: int,
              final: bool) -> DataFrame:
    """Regions of each bucket judged; what is known already passes through."""
    reach = length - K

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        out = _Outbox(buckets)
        held: list[tuple] = []

        def judged() -> Iterator[tuple]:
            # Anchors with one region are unique after all: equal fingerprints differed.
            held.sort(key=lambda r: (r[0], r[1], r[2], r[4]))
            held[:] = list(distinct(held))
            hashes = np.array([r[0] for r in held], np.uint64)
            edge = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            sizes = np.diff(np.append(edge, len(held)))
            some: list[tuple] = []
            weight = 0
            for b, k in zip(edge.tolist(), sizes.tolist(), strict=True):
                group = held[b:b + k]
                if k == 1 and not (group[0][8] is None and _lots(group[0][7]) > 1):
                    continue
                some += group
                weight += sum(len(r[6]) for r in group)
                if weight > ARRAY_BYTES:
                    settle_regions(some)
                    some, weight = [], 0
            if some:
                settle_regions(some)
            held.clear()
            yield from out.rows()

        def distinct(regions: list[tuple]) -> Iterator[tuple]:
            """Without those equal to an earlier one, which are repeats throughout."""
            first: dict[tuple, tuple] = {}
            for r in regions:
                if r[8] is not None:
                    yield r
                    continue
                known = first.setdefault((r[4] - r[5], r[6]), r)
                if known is r:
                    yield r
                elif (known[1], known[2], known[4]) != (r[1], r[2], r[4]):
                    out.span(r[3], r[1], r[2], r[5], r[5] + len(r[6]))

        def settle_regions(some: list[tuple]) -> None:
            repeats = repeated_windows(some, length)
            for r, again in zip(some, repeats, strict=True):
                places = np.flatnonzero(again)
                if len(places):
                    cut = np.flatnonzero(np.diff(places) > 1)
                    starts = places[np.append(0, cut + 1)] - reach + r[4]
                    stops = places[np.append(cut, len(places) - 1)] - reach + r[4] + length
                    for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
                        out.span(r[3], r[1], r[2], s, e)
                lots = _lots(r[7])
                if final or lots == 1:
                    continue
                left = r[5] - r[4] + reach
                by_lot: dict[int, int] = {}
                for w in range(left, left + len(r[6]) - length + 1):
                    if not again[w]:
                        window = r[6][w - left:w - left + length]
                        lot = hash_bytes(window) % lots
                        by_lot[lot] = by_lot.get(lot, 0) | 1 << w
                for lot, windows in by_lot.items():
                    region = (*r[:8], windows)
                    out.region(_home(region, buckets, lot + 1), region)

        bucket = None
        for r in records:
            if r["bucket"] != bucket:
                if held:
                    yield from judged()
                bucket = r["bucket"]
            if r["kind"] == 1:
                yield r["bucket"], 1, r["block"], r["data"]
            else:
                held += pickle.loads(unsqueezed(r["data"]))
        if held:
            yield from judged()

    return map_rows(dealt(sent, tasks, "bucket"), _SENT, rows)


def remove_repeats(docs: DataFrame, length: int = 100, keep: Sequence[str] = ("doc_id",),
                   as_text: bool = False) -> DataFrame:
    """`keep`, n_bytes, begins and ends of the removed runs, and the rest of the bytes.

    As a text, the rest loses characters of which a byte was removed.
    """
    if length < K + 8:
        raise ValueError(f"strings of at least {K + 8} bytes")
    blocks, tasks = blocked(docs, keep)
    buckets = 4 * tasks
    none = F.lit(None).cast("binary")
    known = _repeated(_asked(blocks, length, buckets, tasks), tasks).select(
        "block", F.lit(0).alias("kind"), "bucket", "prints", "powers", none.alias("pack"))
    texts = packs(blocks)
    met = dealt(known.unionByName(texts.select(
        "block", F.lit(1).alias("kind"), F.lit(0).alias("bucket"), none.alias("prints"),
        none.alias("powers"), "pack")), tasks, "block", "kind")
    sent = _regions(met, length, buckets)
    once = _resolved(sent, length, buckets, tasks, final=False)
    spans = _resolved(once, length, buckets, tasks, final=True).select(
        "block", F.lit(0).alias("kind"), "data")
    back = dealt(spans.unionByName(texts.select(
        "block", F.lit(1).alias("kind"), F.col("pack").alias("data"))), tasks, "block", "kind")

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        block, parts, found = None, [], {}
        for r in records:
            if r["block"] != block:
                block, parts, found = r["block"], [], {}
            if r["kind"] == 0:
                parts.append(np.frombuffer(r["data"], _SPAN))
                continue
            if parts:
                every = merged(np.concatenate(parts))
                new = np.flatnonzero(np.append(True, (every["id"][1:] != every["id"][:-1])
                                               | (every["mark"][1:] != every["mark"][:-1])))
                for part in np.split(every, new[1:]):
                    found[int(part["id"][0]), int(part["mark"][0])] = part
                parts = []
            for key, kept, raw in read_pack(r["data"]):
                part = found.get((LAST_ID if key is None else key, mark(raw)))
                begins = part["begin"].tolist() if part is not None else []
                ends = part["end"].tolist() if part is not None else []
                rest = b"".join(raw[a:b] for a, b in zip(
                    [0, *ends], [*begins, len(raw)], strict=True))
                yield (*kept, len(raw), begins, ends,
                       rest.decode(errors="ignore") if as_text else rest)

    return map_rows(back, f"{ddl(docs, keep)}, n_bytes long, begins array<long>, "
                          f"ends array<long>, rest {'string' if as_text else 'binary'}", rows)
