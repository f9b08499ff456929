"""Passages that several documents share: near copies of paragraphs by MinHash, pasted words by anchors.

Natural paragraphs are the lines of at least ``LINE_WORDS`` words, or the whole
text where all its lines are shorter.  The signature of a paragraph is the least
hashes of its shingles under one permutation, as many as the similarity asked for
allows to be missing in a similar paragraph and one more: with 0.8 a fifth of its
``n`` shingles and one.  So the least hash that two similar paragraphs share is in
both signatures, and every link meets in a bucket, however short the paragraph.
Equal paragraphs form a class.  Of the different ones in a bucket, sizes, the rank
of the shared hash in both sets and a bitmap of each set rule out what cannot be
similar; the others are compared by the exact Jaccard similarity of their shingles,
in blocks, of which only a tree over the links leaves a task.

Line breaks say little about passages that were pasted into other texts, so
windows of ``SPAN`` words are laid by content too.  A window is an anchor if its
hash is the smallest of ``REACH`` neighbouring ones, so anchors are at most
``REACH`` places apart.  Any stretch of ``REACH + SPAN - 1`` words or more,
wherever it stands, has the same anchors as its copies; they overlap or touch and
cover all of it but fewer than ``REACH`` words at each end.  The words at the ends
are compared with those around the same window in the first document that has it;
end words that only later documents share are not reported.

Windows are told apart by 96 bits made of their words in two ways: among 10^12
windows two different ones are taken for equal with a probability of about 10^-5.

Of each component of paragraphs, and of each window, that spans two documents or
more, what the smallest document holds is kept and the rest are removals.

Defined results: a paragraph of fewer than ``LINE_WORDS`` words is none.  NULL and
empty texts have no words.  Rows that share a document number are one document,
so a passage they share alone is no repeat.  Rows without a number take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.blocks import block_pairs, join_groups, local_roots, pieces, sides
from clicktally.llm.codepoints import batched, mixed, points
from clicktally.llm.components import components
from clicktally.llm.shingles import BLOCK_CHARS
from clicktally.llm.tables import identified_texts, written, written_to
from clicktally.sources.scratch import scratch_path, scratch_scope

SHINGLE_WORDS, SPAN, REACH = 5, 12, 12
LINE_WORDS = 8
#: The bits that say which shingles a paragraph may have, as long numbers of 64.
BITMAP = 2
_PLACE_BITS, _PLACE_MASK = np.uint64(26), np.uint64((1 << 26) - 1)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Code points and places in a word up to which hashes are looked up, and numbers worked on at once.
_SIGNS, _PLACES, _STEP = 256, 32, 1 << 15


@cache
def _sign_hashes() -> np.ndarray:
    """What each of the first code points, A-Z lower-cased, adds to the hash of a word at each of the first places."""
    signs = np.arange(_SIGNS, dtype=np.uint64)
    signs[65:91] += np.uint64(32)
    places = np.arange(_PLACES, dtype=np.uint64) << np.uint64(24)
    return mixed(signs + places[:, None] + np.uint64(1)).ravel()


def _stretch_hashes(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``span_hashes`` of ``chars`` with A-Z lower-cased, mostly looked up."""
    place = np.arange(len(chars), dtype=np.int32)
    place -= np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(chars))))
    rare = np.flatnonzero((chars >= _SIGNS) | (place >= _PLACES))
    at = place * np.int32(_SIGNS) + chars.astype(np.int32)
    at[rare] = 0
    hashes = _sign_hashes()[at]
    own = chars[rare].astype(np.uint64)
    own[(own >= 65) & (own <= 90)] += np.uint64(32)
    hashes[rare] = mixed(own + (place[rare].astype(np.uint64) << np.uint64(24)) + np.uint64(1))
    return np.add.reduceat(hashes, starts)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """``shingle_hashes`` of ``size`` words or more, made in place and in steps; of fewer words none."""
    out = np.empty(max(len(words) - size + 1, 0), np.uint64)
    spare = np.empty(min(len(out), _STEP), np.uint64)
    for at in range(0, len(out), _STEP):
        x = out[at : at + _STEP]
        y = spare[: len(x)]
        x[:] = words[at : at + len(x)]
        for k in range(size):
            if k:
                np.multiply(x, np.uint64(31), out=x)
                np.add(x, words[at + k : at + k + len(x)], out=x)
            # As ``mixed`` does.
            for shift, factor in ((31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9), (32, 1)):
                np.right_shift(x, np.uint64(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                if factor > 1:
                    np.multiply(x, np.uint64(factor), out=x)
    return out


class _Sets:
    """The distinct hashes of several stretches of ``runs``, sorted: ``own``, one stretch after the other, ``of`` which
    each is, and ``bounds`` where the stretches begin among them."""

    def __init__(self, runs: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        total, self.total = int(counts.sum()), len(counts)
        of = np.repeat(np.arange(len(counts)), counts)
        own = runs[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)]
        # Sorted as one number, the stretch in front; the last bits that this leaves out hardly ever matter.
        order = np.argsort(self._named(of, own))
        sorted_ = own[order]
        again = of[1:] == of[:-1]
        if (again & (sorted_[1:] < sorted_[:-1])).any():
            sorted_ = own[np.lexsort((own, of))]
        fresh = np.append(True, ~again | (sorted_[1:] != sorted_[:-1]))[:total]
        self.own, self.of = sorted_[fresh], of[fresh]
        self.sizes = np.bincount(self.of, minlength=self.total)
        self.bounds = np.append(0, np.cumsum(self.sizes))

    def _named(self, of: np.ndarray, own: np.ndarray) -> np.ndarray:
        bits = np.uint64(max(self.total - 1, 1).bit_length())
        return (of.astype(np.uint64) << (np.uint64(64) - bits)) | (own >> bits)

    def ranks(self, of: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each hash in the set of its stretch, and whether it is there."""
        end = self.bounds[of + 1]
        at = np.searchsorted(self._named(self.of, self.own), self._named(of, own))
        at = np.clip(at, self.bounds[of], end)
        while len(self.own) and (low := (at < end) & (self.own[np.minimum(at, len(self.own) - 1)] < own)).any():
            at += low
        there = at < end
        there[there] = self.own[at[there]] == own[there]
        return at - self.bounds[of], there

    def bitmaps(self) -> np.ndarray:
        bits = np.zeros((self.total, 64 * BITMAP), bool)
        bits[self.of, (self.own % np.uint64(64 * BITMAP)).astype(np.int64)] = True
        return np.packbits(bits, axis=1).view(np.int64)


class Words:
    """The words of several texts: their hashes one after the other, and where texts and lines begin among them."""

    def __init__(self, texts: list[str]):
        chars = points("\n".join(texts) + "\n")
        gap = (chars == 0x20) | ((chars >= 9) & (chars <= 13))
        opens = np.flatnonzero(np.append(True, gap[1:] != gap[:-1]))
        word = ~gap[opens]
        places = opens[word]
        self.hashes = _stretch_hashes(chars, opens)[word]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.bounds = np.append(0, np.searchsorted(places, ends))
        lines = np.append(0, np.searchsorted(places, np.flatnonzero(chars == 0x0A)))
        self.line_starts, self.line_sizes = lines[:-1], np.diff(lines)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        """The text that each word belongs to."""
        return np.searchsorted(self.bounds, places, side="right") - 1

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and number of words of each natural paragraph."""
        long = self.line_sizes >= LINE_WORDS
        starts, sizes = self.line_starts[long], self.line_sizes[long]
        whole = np.diff(self.bounds)
        whole[self.text_of(starts)] = 0
        rest = np.flatnonzero(whole >= LINE_WORDS)
        return np.append(starts, self.bounds[rest]), np.append(sizes, whole[rest])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of the smallest of each ``REACH`` neighbouring windows of a text, of all where there are
        fewer, and the hashes of the windows at all places."""
        total = len(self.hashes)
        windows = np.full(total, _LAST)
        if total >= SPAN:
            windows[: total - SPAN + 1] = _runs(self.hashes, SPAN)
        sizes = np.maximum(np.diff(self.bounds) - SPAN + 1, 0)  # windows of each text
        of_text = np.arange(total) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        sizes_here = np.repeat(sizes, np.diff(self.bounds))
        inside = of_text < sizes_here
        # The place goes into the low bits, so that the minimum names it and equal hashes go by place.
        least = np.where(inside, windows >> _PLACE_BITS << _PLACE_BITS, _LAST) | np.arange(total, dtype=np.uint64)
        first = least
        reach = 1
        while 2 * reach <= REACH:
            first = np.minimum(first[: max(len(first) - reach, 0)], first[reach:])
            reach *= 2
        rest = REACH - reach
        if rest:
            first = np.minimum(first[: max(len(first) - rest, 0)], first[rest:])
        whole = of_text[: len(first)] <= sizes_here[: len(first)] - REACH
        found = [(first[whole] & _PLACE_MASK).astype(np.int64)]
        for k in np.flatnonzero((sizes > 0) & (sizes < REACH)).tolist():
            found.append(np.array([self.bounds[k] + int(np.argmin(least[self.bounds[k] : self.bounds[k] + sizes[k]]))]))
        return np.unique(np.concatenate(found)), windows

    def folded(self, starts: np.ndarray, size: int, factor: int = 31) -> np.ndarray:
        """A hash of ``size`` words from each of some places on."""
        out = mixed(self.hashes[starts])
        for k in range(1, size):
            out = mixed(out * np.uint64(factor) + self.hashes[starts + k])
        return out

    def signatures(self, starts: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The least shingle hashes of each paragraph, and which paragraph each is of."""
        sets = self.sets(starts, sizes)
        rank = np.arange(len(sets.own)) - sets.bounds[sets.of]
        least = rank <= (sets.sizes - -(-percent * sets.sizes // 100))[sets.of]
        return sets.own[least], sets.of[least]

    def sets(self, starts: np.ndarray, sizes: np.ndarray) -> _Sets:
        """The shingles of stretches of words."""
        return _Sets(self.shingles, starts, np.maximum(sizes - SHINGLE_WORDS + 1, 0))

    @cached_property
    def shingles(self) -> np.ndarray:
        return _runs(self.hashes, SHINGLE_WORDS)


def _check(words: Words, starts: np.ndarray) -> np.ndarray:
    """Thirty-two bits more of each window, made in another way than its hash."""
    return (words.folded(starts, SPAN, factor=0x9E3779B1) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def keys_of(texts: list[str], percent: int) -> tuple[np.ndarray, ...]:
    """Key, check, text, first word in the text, and words of each anchor (0) and of each paragraph, once for each
    hash of its signature."""
    words = Words(texts)
    places, windows = words.anchors()
    starts, sizes = words.paragraphs()
    least, of = words.signatures(starts, sizes, percent)
    key = np.concatenate((windows[places], least))
    check = np.concatenate((_check(words, places), np.zeros(len(least), np.int32)))
    place = np.concatenate((places, starts[of]))
    n = np.concatenate((np.zeros(len(places), np.int32), sizes[of].astype(np.int32)))
    text = words.text_of(place)
    return key.view(np.int64), check, text, (place - words.bounds[text]).astype(np.int32), n


#: Few columns, and the one that varies least at the end: shuffled rows are smaller so.
_KEYS = "key long, check int, place long, doc_id long"


def _keys(percent: int) -> Callable:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for block in batched(rows, lambda row: len(row[1]), BLOCK_CHARS):
                key, check, text, first, n = keys_of([text for _, text in block], percent)
                doc_ids = np.array([doc_id for doc_id, _ in block], np.int64)[text]
                place = n.astype(np.int64) << 32 | first
                yield pa.record_batch(
                    [pa.array(c) for c in (key, check, place, doc_ids)], names=["key", "check", "place", "doc_id"]
                )

    return keys


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_shared`` of rows as ``_keys`` has them."""

    def apart(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, check, place, doc_id = batch.columns
        at = place.to_numpy()
        columns = [key, check, doc_id, pa.array((at & 0xFFFFFFFF).astype(np.int32)), pa.array((at >> 32).astype(np.int32))]
        return pa.record_batch(columns, names=["key", "check", "doc_id", "first", "n"])

    yield from _shared(map(apart, batches))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, check and document those whose key several documents have, and whether theirs is the
    first of these.  Held back are only the rows of the first document of the last key."""
    held: tuple[np.ndarray, ...] | None = None
    open_key, open_doc = None, None  # the last key, if more than one document is known to have it, and the first of them
    for batch in batches:
        columns = tuple(batch.column(c).to_numpy() for c in range(5))
        if held is not None:
            columns = tuple(np.concatenate(pair) for pair in zip(held, columns, strict=True))
        key, check, doc_id, first, n = columns
        total = len(key)
        if not total:
            continue
        opens = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1])))
        sizes = np.diff(np.append(opens, total))
        first_doc, last_doc = doc_id[opens], doc_id[opens + sizes - 1]
        if open_key == (key[0], check[0]):
            first_doc[0] = open_doc
        shared = first_doc < last_doc
        if shared[-1]:
            held, open_key, open_doc = None, (key[-1], check[-1]), first_doc[-1]
        else:
            held, open_key = tuple(c[opens[-1] :] for c in columns), None
        keep = np.repeat(shared, sizes)
        kept = doc_id == np.repeat(first_doc, sizes)
        yield pa.record_batch(
            [pa.array(c[keep]) for c in (doc_id, key, first, n, kept)], names=["doc_id", "key", "first", "n", "kept"]
        )


_NATURAL, _CHAIN, _ENDS = 0, 1, 2
_FOUND = """kind int, key long, doc_id long, first int, n int, kept boolean, windows int,
    keys array<long>, ranks array<int>, size int, b0 long, b1 long, words string, left string, right string"""
_FOUND_KINDS = dict(zip(
    [field.split()[0] for field in _FOUND.split(",")],
    (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int64()),
     pa.list_(pa.int32()), pa.int32(), *[pa.int64()] * BITMAP, pa.string(), pa.string(), pa.string()),
    strict=True,
))


def _found_batch(rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Some columns of ``_FOUND``, the others NULL."""
    return pa.record_batch([columns.get(c, pa.nulls(rows, kind)) for c, kind in _FOUND_KINDS.items()], names=list(_FOUND_KINDS))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts and the keys they share: paragraphs with their words, runs of shared windows, and the words
    beside windows at the ends of runs and beside windows of which this is the first document."""
    for batch in batches:
        asked = batch.column("asked")
        key, first, n, kept = (
            asked.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("key", "first", "n", "kept")
        )
        ends = np.cumsum(asked.value_lengths().to_numpy(zero_copy_only=False))
        of_doc = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist())
        for block in batched(of_doc, lambda row: len(row[1]), BLOCK_CHARS):
            own = slice(block[0][2], block[-1][3])
            text = np.repeat(np.arange(len(block)), [high - low for *_, low, high in block])
            order = np.lexsort((key[own], n[own], first[own], text))
            key_, first_, n_, kept_, text = key[own][order], first[own][order], n[own][order], kept[own][order], text[order]
            doc_ids = np.array([doc_id for doc_id, *_ in block], np.int64)
            split = [text.encode("utf-8", "surrogatepass").lower().split() for _, text, *_ in block]
            line = n_ > 0
            if line.any():
                hashed = Words([text for _, text, *_ in block])
                yield from _paragraphs(hashed, split, doc_ids, text[line], first_[line], n_[line], key_[line])
            rows, columns = [], [c[~line].tolist() for c in (first_, key_, kept_)]
            opens = np.searchsorted(text[~line], np.arange(len(block) + 1)).tolist()
            for k, (low, high) in enumerate(zip(opens[:-1], opens[1:], strict=True)):
                if low < high:
                    rows += _window_rows(block[k][0], split[k], list(zip(*(c[low:high] for c in columns), strict=True)))
            if rows:
                columns = zip(_WINDOW_COLUMNS, zip(*rows, strict=True), strict=True)
                yield _found_batch(len(rows), {c: pa.array(own, _FOUND_KINDS[c]) for c, own in columns})


def _joined_words(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "replace")


def _paragraphs(
    hashed: Words, split: list[list[bytes]], doc_ids: np.ndarray, text: np.ndarray, first: np.ndarray, n: np.ndarray, key: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """One row for each paragraph, from sorted rows one for each hash that it shares."""
    new = np.append(True, (text[1:] != text[:-1]) | (first[1:] != first[:-1]) | (n[1:] != n[:-1]))
    once = new | np.append(True, key[1:] != key[:-1])
    of, key = np.cumsum(new)[once] - 1, key[once].view(np.uint64)
    text, first, n = text[new], first[new], n[new]
    # A paragraph of another text of the same number may go on where this text ends.
    starts = hashed.bounds[text] + first
    sizes = np.maximum(np.minimum(n, hashed.bounds[text + 1] - starts), 0)
    for low, high in _portions(sizes, BLOCK_CHARS):
        here = slice(*np.searchsorted(of, [low, high]))
        sets = hashed.sets(starts[low:high], sizes[low:high])
        ranks, there = sets.ranks(of[here] - low, key[here])
        keys, ranks, owner = key[here][there].view(np.int64), ranks[there], (of[here] - low)[there]
        held = np.bincount(owner, minlength=high - low)
        rows = np.flatnonzero(held)  # the others are of another text of the same number
        if not len(rows):
            continue
        offsets = pa.array(np.append(0, np.cumsum(held[rows])), pa.int32())
        data, ends = memoryview(sets.own).cast("B"), (8 * sets.bounds).tolist()
        names = b"".join(hashlib.blake2b(data[ends[k] : ends[k + 1]], digest_size=8).digest() for k in rows.tolist())
        bitmaps = sets.bitmaps()[rows]
        at = zip(*(c[low:high][rows].tolist() for c in (text, first, n)), strict=True)
        yield _found_batch(len(rows), {
            "kind": pa.array(np.full(len(rows), _NATURAL, np.int32)),
            "key": pa.array(np.frombuffer(names, "<i8")),
            "doc_id": pa.array(doc_ids[text[low:high][rows]]),
            "first": pa.array(first[low:high][rows]),
            "n": pa.array(n[low:high][rows]),
            "keys": pa.ListArray.from_arrays(offsets, pa.array(keys)),
            "ranks": pa.ListArray.from_arrays(offsets, pa.array(ranks.astype(np.int32))),
            "size": pa.array(sets.sizes[rows].astype(np.int32)),
            **{f"b{k}": pa.array(np.ascontiguousarray(bitmaps[:, k])) for k in range(BITMAP)},
            "words": pa.array([_joined_words(split[k][a : a + size]) for k, a, size in at], pa.string()),
        })


def _portions(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Where to cut a list so that the sizes in a portion add up to about ``limit``."""
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(sizes)]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


_WINDOW_COLUMNS = ["kind", "key", "doc_id", "first", "n", "kept", "windows", "left", "right"]


def _window_rows(doc_id: int, words: list[bytes], asked: list[tuple[int, int, bool]]) -> list[tuple]:
    def beside(first: int) -> tuple[str, str]:
        after = first + SPAN
        return _joined_words(words[max(first - REACH + 1, 0) : first]), _joined_words(words[after : after + REACH - 1])

    rows, ends = [], set()
    at = 0
    for k in range(1, len(asked) + 1) if asked else ():
        run_ends = k == len(asked) or asked[k][0] > asked[k - 1][0] + SPAN
        if run_ends or asked[k][2] != asked[at][2]:
            n = asked[k - 1][0] + SPAN - asked[at][0]
            rows.append((_CHAIN, asked[at][1], doc_id, asked[at][0], n, asked[at][2], k - at, None, None))
            ends.add(at)
            ends.add(k - 1)
            at = k
    for k, (first, key, kept) in enumerate(asked):
        if kept or k in ends:
            rows.append((_ENDS, key, doc_id, first, SPAN, kept, int(k in ends), *beside(first)))
    return rows


def _same_beside(left: pa.Array, right: pa.Array, left_too: pa.Array, right_too: pa.Array) -> pa.Array:
    """How many words beside two windows are the same, going away from them."""

    def same(a: list[str], b: list[str]) -> int:
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    def counted(one: pa.Array, other: pa.Array, step: int) -> pa.Array:
        pairs = zip(one.to_pylist(), other.to_pylist(), strict=True)
        return pa.array([same(a.split()[::step], b.split()[::step]) for a, b in pairs], pa.int32())

    return pa.StructArray.from_arrays([counted(left, left_too, -1), counted(right, right_too, 1)], ["before", "after"])


def _hopeful(percent: int) -> Callable:
    """Of the members of each pair of blocks of a bucket, sorted by these, those that may be similar to another one
    there.  Held back is the last pair of blocks of a batch."""
    names = ["key", "i", "j", "id", "size", "rank", *(f"b{k}" for k in range(BITMAP))]

    def met(columns: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        size, rank = columns[4].astype(np.int64), columns[5]
        bits, left, found = [c.view(np.uint64) for c in columns[6:]], size - rank, np.zeros(len(size), bool)
        at, step = np.arange(len(size)), 1
        # Each row with the one so many places on, as far as its piece goes.
        while len(at := at[at + step < ends[at]]):
            both = size[at] + size[at + step]
            least = -(-percent * both // (100 + percent))  # that many shingles two similar ones share
            # The first hash that both have is followed by the others that they share.
            near = np.minimum(left[at], left[at + step]) >= least
            x, most = at[near], (both - 2 * least)[near]
            apart = sum(np.bitwise_count(b[x] ^ b[x + step]).astype(np.int64) for b in bits)
            x = x[apart <= most]
            found[x] = found[x + step] = True
            step += 1
        return found

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            columns = held
            if batch is not None:
                columns = [batch.column(c).to_numpy() for c in names]
                if held is not None:
                    columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if columns is None or not len(columns[0]):
                continue
            changes = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
            opens = np.flatnonzero(np.append(True, changes))
            whole = len(columns[0]) if batch is None else opens[-1]
            held = [c[whole:] for c in columns]
            columns = [c[:whole] for c in columns]
            sizes = np.diff(np.append(opens[opens < whole], whole))
            own = met(columns, np.repeat(np.cumsum(sizes), sizes))
            yield pa.record_batch([pa.array(columns[c][own].astype(np.int64)) for c in (0, 3, 4)], names=["key", "id", "size"])

    return hopeful


def _linked(percent: int) -> Callable:
    """A tree over the links of each pair of blocks of a bucket."""

    def links(piece: list[dict]) -> list[tuple[int, int]]:
        x, y, same = sides(piece)
        ids = np.array([row["id"] for row in piece])
        sets = [np.frombuffer(row["shingles"], np.uint64) for row in piece]
        sizes = np.array([len(own) for own in sets])
        root = ids.copy()
        for at, k in enumerate(x.tolist()):
            # Those that links already join need no comparison.
            other = y[at + 1 :] if same else y
            other = other[root[other] != root[k]]
            other = other[100 * np.minimum(sizes[other], sizes[k]) >= percent * np.maximum(sizes[other], sizes[k])]
            if not len(other):
                continue
            flat = np.concatenate([sets[o] for o in other.tolist()])
            place = np.minimum(np.searchsorted(sets[k], flat), sizes[k] - 1)
            shared = np.add.reduceat(sets[k][place] == flat, np.cumsum(sizes[other]) - sizes[other])
            near = other[100 * shared >= percent * (sizes[other] + sizes[k] - shared)]
            if len(near):
                joined = np.isin(root, np.append(root[near], root[k]))
                root[joined] = root[joined].min()
        return [(int(r), int(i)) for r, i in zip(root, ids, strict=True) if r != i]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ["key"]):
            a, b = zip(*found, strict=True) if (found := links(piece)) else ([], [])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return linked


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted shingle hashes of paragraphs."""
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for block in batched(rows, lambda row: len(row[1]), BLOCK_CHARS):
            hashed = Words([words for _, words in block])
            sets = hashed.sets(hashed.bounds[:-1], np.diff(hashed.bounds))
            data, ends = sets.own.tobytes(), (8 * sets.bounds).tolist()
            own = [data[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch(
                [pa.array([key for key, _ in block], pa.int64()), pa.array(own, pa.binary())], names=["id", "shingles"]
            )


def _paragraph_links(natural: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between classes of paragraphs that join all that are similar."""
    standing = (
        natural.select(F.explode(F.arrays_zip("keys", "ranks")).alias("met"), "id", "size")
        .groupBy(F.col("met.keys").alias("key"), "id")
        .agg(F.max("met.ranks").alias("rank"), F.max("size").alias("size"), F.lit(1).alias("weight"))
    )
    bitmaps = classes.select("id", *(f"b{k}" for k in range(BITMAP)))
    met = block_pairs(written(standing, "standing"), ["key"], bitmaps, block_rows=2048)
    hopeful = written(
        met.mapInArrow(_hopeful(percent), "key long, id long, size long")
        .groupBy("key", "id")
        .agg(F.max("size").alias("weight")),
        "hopeful",
    )
    # Similar paragraphs meet once for each hash that they share: of buckets with the same members one is enough.
    buckets = hopeful.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64("id")).alias("members"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("members_too"),
    )
    different = buckets.groupBy("rows", "members", "members_too").agg(F.min("key").alias("key")).select("key")
    once = written(hopeful.join(different, "key", "left_semi"), "hopeful-once")
    words = (
        natural.select("id", "words").join(hopeful.select("id").distinct(), "id", "left_semi")
        .groupBy("id").agg(F.first("words").alias("words"))
    )
    sets = written(words.mapInArrow(_shingle_sets, "id long, shingles binary"), "paragraph-shingles")
    return written(block_pairs(once, ["key"], sets).mapInArrow(_linked(percent), "a long, b long"), "paragraph-links")


def _extended(ends: DataFrame) -> DataFrame:
    """The windows at the ends of runs with the words beside them that the first document has as well; for the
    first document, those that one of the others has."""
    same_beside = F.arrow_udf(_same_beside, "before int, after int")
    own = F.when(F.col("kept"), F.struct("first", "left", "right"))
    first = ends.groupBy("key").agg(
        F.min(own).alias("own"), F.min(F.when(F.col("kept"), F.col("doc_id"))).alias("owner"), F.count_if(~F.col("kept")).alias("rows")
    )
    met = (
        join_groups(ends.filter(~F.col("kept")), first.filter("own is not null and rows > 0"), ["key"])
        .withColumn("same", same_beside("left", "right", "own.left", "own.right"))
        .select("key", "doc_id", "first", "owner", F.col("own.first").alias("own_first"), "same.before", "same.after")
    )
    met = written(met, "ends")
    others = met.select("doc_id", "first", F.lit(False).alias("kept"), "before", "after", "key")
    firsts = met.groupBy("key").agg(
        F.min("owner").alias("doc_id"), F.min("own_first").alias("first"), F.max("before").alias("before"), F.max("after").alias("after")
    ).select("doc_id", "first", F.lit(True).alias("kept"), "before", "after", "key")
    return others.unionByName(firsts).filter("before > 0 or after > 0").select(
        "doc_id", "kept", F.col("key").alias("component_id"), (F.col("first") - F.col("before")).alias("place"),
        (F.col("first") + SPAN + F.col("after")).alias("end"), F.lit(0).alias("windows"),
    )


def repeated_passages(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``first_word``, ``end_word``, ``kept``, ``n_paragraphs``, ``component_id``: the stretches of
    words (from 0, the end not included) that documents share, one row for each in each document.

    ``n_paragraphs`` counts the shared windows and paragraphs of the stretch,
    ``component_id`` is the smallest of the hashes that name their components;
    ``kept`` is whether this document is the first to hold it.
    Documents without shared passages do not appear.
    """
    texts = identified_texts(docs, id_col, text_col).filter("doc_id is not null")
    spark = docs.sparkSession
    found_path = scratch_path(spark, "paragraphs")
    with scratch_scope(spark):
        # Written, so that the room of all keys can be had again; they take more than the texts do.
        shared_keys = written(
            texts.mapInArrow(_keys(percent), _KEYS)
            .repartition("key")
            .sortWithinPartitions("key", "check", "doc_id")
            .mapInArrow(_shared_keys, "doc_id long, key long, first int, n int, kept boolean"),
            "shared-keys",
        )
        places = shared_keys.groupBy("doc_id").agg(F.collect_list(F.struct("key", "first", "n", "kept")).alias("asked"))
        asked = texts.join(places, "doc_id").select("doc_id", "text", "asked")
        found = written_to(asked.mapInArrow(_found, _FOUND), found_path)
    natural = found.filter(F.col("kind") == _NATURAL).select(
        F.col("key").alias("id"), "doc_id", "first", "n", "keys", "ranks", "size", *(f"b{k}" for k in range(BITMAP)), "words"
    )
    classes = written(
        natural.groupBy("id").agg(
            *(F.first(f"b{k}").alias(f"b{k}") for k in range(BITMAP)), F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    links = _paragraph_links(natural, classes, percent)
    # Copies go where the one that stands for them goes, so components are sought among those only.
    joined = components(links).select(F.col("node").alias("id"), F.col("component_id").alias("whole"))
    placed = classes.join(joined, "id", "left").withColumn("component_id", F.coalesce("whole", "id"))
    spread = (
        placed.groupBy("component_id")
        .agg(F.min("low").alias("first_doc"), F.max("high").alias("last_doc"), F.count(F.lit(1)).alias("rows"))
        .filter("first_doc < last_doc")
        .drop("last_doc")
    )
    shared_classes = join_groups(placed, spread, ["component_id"]).select(
        "id", "component_id", "first_doc", F.col("copies").alias("rows")
    )
    paragraphs = join_groups(natural.select("id", "doc_id", "first", "n"), shared_classes, ["id"]).select(
        "doc_id", (F.col("doc_id") == F.col("first_doc")).alias("kept"), "component_id", F.col("first").alias("place"),
        (F.col("first") + F.col("n")).alias("end"), F.lit(1).alias("windows"),
    )
    chains = found.filter(F.col("kind") == _CHAIN).select(
        "doc_id", "kept", F.col("key").alias("component_id"), F.col("first").alias("place"),
        (F.col("first") + F.col("n")).alias("end"), "windows",
    )
    ends = found.filter(F.col("kind") == _ENDS).select("key", "doc_id", "first", "kept", "left", "right")
    shared = written(paragraphs.unionByName(chains).unionByName(_extended(ends)), "shared-stretches")
    removed = _joined(shared.filter("not kept"))
    # At the edge of a passage a window may be an anchor in some documents only, the first of which need not be the
    # first to hold the passage: what lies in a removed stretch is not kept.
    order = Window.partitionBy("doc_id").orderBy("place", "kept", F.desc("end"))
    until = F.max(F.when(~F.col("kept"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    mixed_ = removed.unionByName(shared.filter("kept")).withColumn("until", until)
    own = _joined(mixed_.filter(F.col("kept") & (F.coalesce("until", F.lit(0)) < F.col("end"))).drop("until"))
    return removed.unionByName(own).select(
        "doc_id", "kept", F.col("place").cast("long").alias("first_word"), F.col("end").cast("long").alias("end_word"),
        F.col("windows").alias("n_paragraphs"), "component_id",
    )


def _joined(shared: DataFrame) -> DataFrame:
    """Stretches that overlap in a document as one."""
    order = Window.partitionBy("doc_id").orderBy("place", "component_id")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("place") >= before, F.lit(True))
    stretches = shared.withColumn("fresh", fresh).withColumn("stretch", F.sum(F.col("fresh").cast("int")).over(order))
    return stretches.groupBy("doc_id", "kept", "stretch").agg(
        F.min("component_id").alias("component_id"),
        F.min("place").alias("place"),
        F.max("end").alias("end"),
        F.sum("windows").alias("windows"),
    ).drop("stretch")
