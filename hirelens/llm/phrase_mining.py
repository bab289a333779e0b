"""Collocations by prefix-free parsing.

Texts are cut into pieces at punctuation and line ends and these into words.
A window of four words whose hash is 0 modulo ``PERIOD`` is a trigger: a chunk
runs from one trigger (or the piece's start) to the end of the next (or the
piece's end).  Neighbouring chunks so overlap by the trigger's four words, and
every phrase of up to five words lies whole in the chunk in whose *core* it
starts, the words before the next trigger; it is counted there and nowhere
else.  Since only the content sets the cuts, copied passages give the same
chunks wherever they stand: the *dictionary* holds each distinct chunk of a
language once, with its parse frequency, and all counting reads the dictionary
and weights by that frequency.

Phrases are counted level by level.  A phrase of n words can reach ``least``
only if both its phrases of n - 1 words do, so only those are hashed, summed
by hash and kept where the sum reaches ``least``; the next level sees the
kept hashes as a bitmap of at most 2^``MOST_BITS`` bits (32 MB, whatever the
corpus; a fuller bitmap prunes less and never wrongly).  A last pass emits the
words of what the bitmaps let through and sums them exactly by phrase, so no
hash collision reaches the result.

Rows of Spark are wide: a row of the dictionary holds some thousand chunks as
numbers of words, the words beside them, so that no pass cuts or hashes text
again; chunks, hashes and phrases leave a task counted and by buckets of their
hash, those of a bucket in one row, and are summed by array operations.

Scores are DECIMAL(38): exact.  A language may hold any share of the rows:
sums go by (language, phrase), combined before each shuffle, and the first
``top`` of a language are taken within tasks before they meet.

Defined results: a null text is empty, a null language ``und`` (as is the
language ``und`` itself); repeated rows count as often as they stand; a table
without words gives no rows; ids and further columns are not read.  Texts are
taken in blocks cut at piece ends, so a task holds one block, however long the
text; a single piece is held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import SLICE_BYTES, again, dropped, spooled, text_slices
from hirelens.session import _bytes

#: Words of the longest phrase; a trigger has one word less.
MOST_WORDS = 5
#: One window in so many is a trigger.
PERIOD = 16
#: Occurrences that make a phrase a candidate.
LEAST = 100
#: A longer candidate that holds so many percent of a phrase's occurrences drops it.
COVER = 100
#: Phrases reported per language.
TOP = 2_000
#: Largest bitmap of frequent phrases, as a power of 2, and bits per phrase below that.
MOST_BITS, BITS_EACH = 28, 16
#: Dictionary bytes counted at once, chunk bytes of a row of the dictionary, those counted in a task before they
#: leave it, and phrases likewise.
BLOCK_BYTES, ROW_BYTES, CHUNK_BYTES, SUM_ROWS = 5_000_000, 300_000, 16_000_000, 2_000_000
#: Rows that are read, and bytes that go to Python, at once: rows of the dictionary are wide.
READ_ROWS, SENT_BYTES = 16, 4 << 20
#: What leaves a task goes by 2^BUCKET_BITS buckets, a row for all of a bucket.
BUCKET_BITS = 10
#: Largest weight that shares a number with its key; takes the key's lower bits.
MOST_WEIGHT = (1 << 16) - 1

BLANK, END = 1, 2
#: What ends a chunk (a phrase): no word has these bytes.
STOPS, GOES_ON = 0x0A, 0x0B
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = END
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: BASE * BACK = 1 modulo 2^64; a byte's value in a word (a blank has none); powers made at once.
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
VALUE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * BASE
VALUE[0x20] = 0
POWER_BITS = 11


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the information of each 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, count: int) -> np.ndarray:
    """1, base, base^2, ... (modulo 2^64)."""
    few = np.full(1 << POWER_BITS, base)
    few[0] = 1
    few = np.cumprod(few)
    many = np.repeat(few[-1:] * base, ((count - 1) >> POWER_BITS) + 1)
    many[0] = 1
    return np.multiply.outer(np.cumprod(many), few).ravel()[:count]


def hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word in bytes where words follow each other, with or
    without a blank after them: the sum of its bytes' values times powers of
    ``BASE``, which count from the first byte of all; dividing by the power
    at a word's start makes it the word's own."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = VALUE[data]
    values *= powers(BASE, len(data))
    values = np.add.reduceat(values, starts)
    few = powers(BACK, 1 << POWER_BITS)
    many = powers((few[-1:] * BACK)[0], (int(starts[-1]) >> POWER_BITS) + 1)
    values *= many[starts >> POWER_BITS]
    values *= few[starts & ((1 << POWER_BITS) - 1)]
    return mixed(values)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte ranges one after another, and the offsets of each and of the end."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    kind = np.int32 if max(len(data), offsets[-1]) < 1 << 31 else np.int64
    places = np.arange(offsets[-1], dtype=kind)
    places += np.repeat((starts - offsets[:-1]).astype(kind), lengths)
    return data[places], offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes between the offsets, without a copy."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def taken(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of ``strings``."""
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def unended(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Chunks or phrases without the byte that ends each."""
    data, offsets = gathered(data, offsets[:-1], offsets[1:] - 1)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between the bounds, each range as the bytes of one row."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - BUCKET_BITS)


def by_bucket(parts: DataFrame, *also: str) -> DataFrame:
    """Rows of a bucket in one task, one after another."""
    return parts.repartition("bucket").sortWithinPartitions("bucket", *also)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other with the same first columns: these, and the others of each row."""
    last, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, row in zip(zip(*columns[:keys]), zip(*columns[keys:])):
            if key != last:
                if rows:
                    yield last, rows
                last, rows = key, []
            rows.append(row)
    if rows:
        yield last, rows


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The texts of a batch in blocks of about ``SLICE_BYTES``: row number in
    the batch, bytes and offsets.  A longer text is cut after piece ends."""
    done = 0
    for part, data, offsets in text_slices(batch, column):
        rows = np.arange(done, done + part.num_rows)
        done += part.num_rows
        if len(rows) > 1 or len(data) <= SLICE_BYTES:
            yield rows, data, offsets
            continue
        cuts = np.append(np.flatnonzero(KIND[data] == END) + 1, len(data))
        start = 0
        while start < len(data):
            end = cuts[max(np.searchsorted(cuts, start + SLICE_BYTES, "right") - 1, np.searchsorted(cuts, start, "right"))]
            yield rows, data[start:end], np.asarray([0, end - start])
            start = int(end)


def chunks(data: np.ndarray, offsets: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chunks of some texts: text number, bytes (words joined by blanks,
    then ``GOES_ON`` or ``STOPS``), offsets and bucket."""
    data = np.insert(data, offsets[1:], STOPS)  # an end after each text
    closes = offsets[1:] + np.arange(len(offsets) - 1)
    kind = KIND[data]
    word = kind == 0
    edges = np.flatnonzero(np.diff(word, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    text = np.searchsorted(closes, starts)
    piece = np.cumsum(kind == END)[starts]
    word[ends] = True  # one blank after each word
    data = LOWER[data]
    data[ends] = 0x20
    data = data[word]
    lengths = ends - starts + 1
    starts = np.cumsum(lengths) - lengths

    window = MOST_WORDS - 1
    begins = np.diff(piece, prepend=-1) != 0
    h = hashes(data, starts)
    if len(starts) >= window:
        rolled = h[:len(h) - window + 1].copy()
        for i in range(1, window):
            rolled = rolled * STEP + h[i:len(h) - window + 1 + i]
        begins[:len(rolled)] |= (mixed(rolled) % np.uint64(period) == 0) & (piece[:len(rolled)] == piece[window - 1:])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(starts))
    goes_on = np.append(piece[first[1:]] == piece[first[:-1]], False)
    last = last + np.where(goes_on, window, 0)
    sums = np.append(np.uint64(0), np.cumsum(h))
    bucket = bucket_of(mixed(sums[last] - sums[first]))
    last -= 1
    out, bounds = gathered(data, starts[first], starts[last] + lengths[last])
    out[bounds[1:] - 1] = np.where(goes_on, GOES_ON, STOPS)
    return text[first], out, bounds, bucket


def counted(parts: list[tuple[np.ndarray, ...]], langs: list[str]) -> Iterator[pa.RecordBatch]:
    """(bucket, lang, chunks, n) of some chunks, given as language number,
    bytes, lengths and buckets: the chunks of a bucket one after another,
    each once, and how often each was there."""
    lang, data, lengths, bucket = (np.concatenate(x) for x in zip(*parts))
    chunk = strings(data, np.append(0, np.cumsum(lengths)))
    if len(langs) > 1:
        order = np.argsort(lang, kind="stable")
        lang, bucket, chunk = lang[order], bucket[order], chunk.take(pa.array(order))
    bounds = np.searchsorted(lang, np.arange(len(langs) + 1))
    for name, begin, end in zip(langs, bounds[:-1], bounds[1:]):
        if begin == end:
            continue
        coded = chunk.slice(begin, end - begin).dictionary_encode()
        code = coded.indices.to_numpy()
        n = np.bincount(code)
        at = np.zeros(len(n), np.uint16)
        at[code] = bucket[begin:end]
        order = np.argsort(at, kind="stable")
        at, n = at[order], n[order].astype(np.int64)
        out, offsets = taken(coded.dictionary.take(pa.array(order)))
        first = np.flatnonzero(np.diff(at.astype(np.int64), prepend=-1))
        rows = np.append(first, len(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[first].astype(np.int32)), pa.array([name] * len(first), pa.string()), blobs(out, offsets[rows]), blobs(n, rows)],
            ["bucket", "lang", "chunks", "n"])


def parsed(docs: DataFrame, text_col: str, lang_col: str, period: int) -> DataFrame:
    """(bucket, lang, chunks, n): the chunks of the texts, counted within tasks."""
    def run(batches):
        parts, langs, size = [], {}, 0
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            number = np.asarray([langs.setdefault(x, len(langs)) for x in coded.dictionary.to_pylist()], np.int64)
            number = number[coded.indices.to_numpy()]
            for rows, data, offsets in blocks(batch, "text"):
                text, data, offsets, bucket = chunks(data, offsets, period)
                parts.append((number[rows[text]], data, np.diff(offsets), bucket))
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield from counted(parts, [*langs])
                    parts, size = [], 0
        if size:
            yield from counted(parts, [*langs])

    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), docs[text_col].alias("text")).mapInArrow(
        run, "bucket int, lang string, chunks binary, n binary")


ROW = "langs array<string>, lang binary, goes_on binary, size binary, n binary, codes binary, words binary"


def row(parts: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row of the dictionary, of (lang, bytes, offsets, n) of chunks: its
    languages; of each chunk the language's number, whether it goes on, its
    words and its frequency; the number of every word; and the words."""
    langs = {x[0]: None for x in parts}
    langs = dict(zip(langs, range(len(langs))))
    data = np.concatenate([x[1] for x in parts])
    ends = np.cumsum(np.concatenate([np.diff(x[2]) for x in parts]))
    goes_on = (data[ends - 1] == GOES_ON).astype(np.uint8)
    data[ends - 1] = 0x20
    after = np.flatnonzero(data == 0x20) + 1
    size = np.diff(np.searchsorted(after, ends, "right"), prepend=0).astype(np.int32)
    coded = strings(data, np.append(0, after)).dictionary_encode()
    lang = np.repeat(np.asarray([langs[x[0]] for x in parts], np.int32), [len(x[3]) for x in parts])
    values = [lang, goes_on, size, np.concatenate([x[3] for x in parts]), coded.indices.to_numpy(), taken(coded.dictionary)[0]]
    return pa.RecordBatch.from_arrays(
        [pa.array([[*langs]], pa.list_(pa.string())), *(pa.array([x.tobytes()], pa.binary()) for x in values)],
        ["langs", "lang", "goes_on", "size", "n", "codes", "words"])


def packed_dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD) -> DataFrame:
    """The dictionary, rows of about ``ROW_BYTES`` of chunks."""
    def run(batches):
        parts, size = [], 0
        for (_, lang), rows in runs(batches, 2):
            data = np.frombuffer(b"".join(x[0] for x in rows), np.uint8)
            n = np.frombuffer(b"".join(x[1] for x in rows), np.int64)
            offsets = np.append(0, np.flatnonzero((data == STOPS) | (data == GOES_ON)) + 1)
            if len(rows) > 1:
                coded = strings(data, offsets).dictionary_encode()
                n = added(coded.indices.to_numpy(), n)
                data, offsets = taken(coded.dictionary)
            at = 0
            while at < len(n):
                end = max(int(np.searchsorted(offsets, offsets[at] + ROW_BYTES - size, "right")) - 1, at + 1)
                parts.append((lang, data[offsets[at]:offsets[end]], offsets[at:end + 1], n[at:end]))
                size += int(offsets[end] - offsets[at])
                at = end
                if at < len(n) or size >= ROW_BYTES:
                    yield row(parts)
                    parts, size = [], 0
        if parts:
            yield row(parts)

    return by_bucket(parsed(docs, text_col, lang_col, period), "lang").mapInArrow(run, ROW)


def added(places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of the values of each place."""
    out = np.zeros(int(places.max()) + 1, np.int64)
    np.add.at(out, places, values)
    return out


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD) -> DataFrame:
    """(lang, chunk, core, n): each distinct chunk of a language, the words of
    its core and how often the parse has it."""
    def run(batches):
        for words in dictionary_words(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([words.langs[i] for i in words.lang], pa.string()),
                 unended(*words.phrases(words.begin[:-1], words.size)), pa.array(words.core), pa.array(words.n)],
                ["lang", "chunk", "core", "n"])

    return packed_dictionary(docs, text_col, lang_col, period).mapInArrow(run, "lang string, chunk string, core bigint, n bigint")


def words_of(entries: DataFrame) -> DataFrame:
    """(lang, n): the words of each language."""
    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                lang, n = np.frombuffer(x["lang"], np.int32), np.frombuffer(x["n"], np.int64)
                core = np.frombuffer(x["size"], np.int32) - (MOST_WORDS - 1) * np.frombuffer(x["goes_on"], np.uint8).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x["langs"], pa.string()), pa.array(added(lang, core * n))], ["lang", "n"])

    return (entries.select("langs", "lang", "goes_on", "size", "n").mapInArrow(run, "lang string, n bigint")
            .groupBy("lang").agg(F.sum("n").alias("n")))


class Words:
    """The words of some rows of the dictionary and the keys of their phrases."""

    def __init__(self, rows: list[dict], distinct: bool):
        def joined(name, kind):
            return np.frombuffer(b"".join(x[name] for x in rows), kind)

        def shifted(name, sizes):
            """Numbers that count in each row, made to count over all."""
            each = [len(x[name]) // 4 for x in rows]
            return joined(name, np.int32) + np.repeat(np.cumsum([0, *sizes[:-1]]).astype(np.int32), each)

        names: dict[str, int] = {}
        number = np.asarray([names.setdefault(lang, len(names)) for x in rows for lang in x["langs"]], np.int32)
        self.langs = [*names]
        self.lang = number[shifted("lang", [len(x["langs"]) for x in rows])]
        self.n = joined("n", np.int64)
        self.size = joined("size", np.int32).astype(np.int64)
        self.core = self.size - (MOST_WORDS - 1) * joined("goes_on", np.uint8)
        self.begin = np.append(0, np.cumsum(self.size))  # first word of each chunk, and the end
        data = joined("words", np.uint8)
        self.codes = shifted("codes", [x["words"].count(b" ") for x in rows])
        self.vocabulary = strings(data, np.append(0, np.flatnonzero(data == 0x20) + 1))
        if distinct and len(rows) > 1:
            coded = self.vocabulary.dictionary_encode()
            self.codes, self.vocabulary = coded.indices.to_numpy()[self.codes], coded.dictionary

    def weights(self, at: np.ndarray) -> np.ndarray:
        if not hasattr(self, "weight"):
            self.weight = np.repeat(self.n, self.size)
        return self.weight[at]

    def room(self) -> np.ndarray:
        """How many words, up to ``MOST_WORDS``, a phrase that starts at each word can have: none beyond the core."""
        room = np.full(len(self.codes), MOST_WORDS, np.uint8)
        for j in range(1, MOST_WORDS):
            room[self.begin[1:][self.size >= j] - j] = np.where(self.core < self.size, 0, j)[self.size >= j]
        return room

    def levels(self, maps: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... words: the places whose phrase has both its shorter
        phrases in the bitmaps, and its key; one level more than there are
        bitmaps.  Places too near a chunk's end for the phrase mean nothing."""
        seeds = np.asarray([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs],
                           np.uint64)
        data, offsets = taken(self.vocabulary)
        one = hashes(data, offsets[:-1])[self.codes]
        one += seeds[0] if len(seeds) == 1 else np.repeat(seeds[self.lang], self.size)
        one = mixed(one)
        at, key = np.arange(len(one)), one
        yield at, key
        for n, frequent in enumerate(maps[:MOST_WORDS - 1], start=1):
            kept = held(np.frombuffer(frequent.value, np.uint8), key)
            there = np.zeros(len(one) + 1, bool)
            there[at[kept]] = True
            kept &= there[at + 1]
            kept[np.searchsorted(at, len(one) - n):] = False
            at, key = at[kept], key[kept]
            key = mixed(key * STEP + one[at + n])
            yield at, key

    def phrases(self, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words from each of some places, joined by blanks and ended by ``STOPS``: bytes and offsets."""
        bounds = np.append(0, np.cumsum(length))
        places = np.arange(bounds[-1]) + np.repeat(at - bounds[:-1], length)
        data, offsets = taken(self.vocabulary.take(pa.array(self.codes[places])))
        data, offsets = data.copy(), offsets[bounds]
        data[offsets[1:] - 1] = STOPS
        return data, offsets


def held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bitmap (of 2^b bits) has each key."""
    bits = int(len(bitmap) * 8).bit_length() - 1
    place = keys >> np.uint64(64 - bits)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def dictionary_words(batches: Iterator[pa.RecordBatch], distinct: bool = False) -> Iterator[Words]:
    """Rows of the dictionary, gathered to blocks of ``BLOCK_BYTES``.
    ``distinct``: a word has one number in all of a block."""
    rows, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            rows += batch.slice(i, 1).to_pylist()
            size += len(rows[-1]["codes"]) + len(rows[-1]["words"])
            if size >= BLOCK_BYTES:
                yield Words(rows, distinct)
                rows, size = [], 0
    if rows:
        yield Words(rows, distinct)


def weighted(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Keys and weights in one number each, which sorts by key: the key's
    upper bits and the weight, larger weights as several numbers."""
    times = -(-weights // MOST_WEIGHT)
    if len(times) and times.max() > 1:
        keys, last = np.repeat(keys, times), np.cumsum(times) - 1
        rest = weights - (times - 1) * MOST_WEIGHT
        weights = np.full(len(keys), MOST_WEIGHT)
        weights[last] = rest
    return (keys & ~np.uint64(MOST_WEIGHT)) | weights.astype(np.uint64)


def summed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of ``weighted`` numbers, sorted, and the sum of each."""
    numbers = np.sort(numbers)
    key = numbers & ~np.uint64(MOST_WEIGHT)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat((numbers & np.uint64(MOST_WEIGHT)).astype(np.int64), first)


def frequent_keys(entries: DataFrame, shorter: list, least: int) -> DataFrame:
    """(key, n): the phrases whose hash (its upper bits) is met ``least``
    times or more; ``shorter`` has the broadcast bitmaps of all shorter ones."""
    n = len(shorter) + 1

    def parts(found):
        numbers = weighted(*summed(np.concatenate(found)))
        at = bucket_of(numbers).astype(np.int32)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        return pa.RecordBatch.from_arrays([pa.array(at[first]), blobs(numbers, np.append(first, len(at)))], ["bucket", "numbers"])

    def run(batches):
        found, size = [], 0
        for words in dictionary_words(batches):
            for at, key in words.levels(shorter):
                pass
            ok = words.room()[at] >= n
            found.append(weighted(key[ok], words.weights(at[ok])))
            size += len(found[-1])
            if size >= SUM_ROWS:
                yield parts(found)
                found, size = [], 0
        if size:
            yield parts(found)

    def total(batches):
        for _, rows in runs(batches, 1):
            key, sums = summed(np.frombuffer(b"".join(x[0] for x in rows), np.uint64))
            ok = sums >= least
            yield pa.RecordBatch.from_arrays([pa.array(key[ok].view(np.int64)), pa.array(sums[ok])], ["key", "n"])

    return by_bucket(entries.mapInArrow(run, "bucket int, numbers binary")).mapInArrow(total, "key bigint, n bigint")


def bitmap(keys: DataFrame) -> bytes | None:
    """The keys as bits, ``BITS_EACH`` or fewer each; None if there is none.
    The driver gets at most 2^(``MOST_BITS`` - 6) words of 64 bits."""
    count = keys.count()
    if not count:
        return None
    bits = min(MOST_BITS, max(16, (BITS_EACH * count - 1).bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    words = keys.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(63).cast("int").alias("bit")).groupBy(
        "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.astype("<i8").tobytes()


def frequent_phrases(entries: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, f): every phrase of one to five words that stands
    ``least`` times or more, counted exactly.  ``entries`` is a spooled
    ``packed_dictionary``."""
    sc = entries.sparkSession.sparkContext
    maps: list = []
    while len(maps) < MOST_WORDS:
        keys = spooled(frequent_keys(again(entries), maps, least), f"frequent-{len(maps) + 1}")
        packed = bitmap(keys)
        dropped(keys)
        if packed is None:
            break
        maps.append(sc.broadcast(packed))

    def run(batches):
        for words in dictionary_words(batches, distinct=True):
            yield from found_phrases(words, maps)

    def total(batches):
        for (_, lang), rows in runs(batches, 2):
            data = np.frombuffer(b"".join(x[0] for x in rows), np.uint8)
            phrase = strings(data, np.append(0, np.flatnonzero(data == STOPS) + 1)).dictionary_encode()
            f = added(phrase.indices.to_numpy(), np.frombuffer(b"".join(x[1] for x in rows), np.int64))
            ok = np.flatnonzero(f >= least)
            if not len(ok):
                continue
            data, offsets = taken(phrase.dictionary.take(pa.array(ok)))
            spaces = np.append(0, np.cumsum(data == 0x20))[offsets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ok), pa.string()), unended(data, offsets),
                 pa.array(np.diff(spaces) + 1, pa.int32()), pa.array(f[ok])], ["lang", "phrase", "words", "f"])

    return (by_bucket(again(entries).mapInArrow(run, "bucket int, lang string, phrases binary, f binary"), "lang")
            .mapInArrow(total, "lang string, phrase string, words int, f bigint"))


def found_phrases(words: Words, maps: list) -> Iterator[pa.RecordBatch]:
    """(bucket, lang, phrases, f): the phrases of a block that the bitmaps let
    through, summed.  Places are sorted by their key's upper bits; those whose
    words differ from the first place's of the same key stand alone."""
    low = np.uint64((1 << max(20, len(words.codes).bit_length())) - 1)
    room, found = words.room(), []
    lang = np.repeat(words.lang, words.size)
    for n, ((at, key), frequent) in enumerate(zip(words.levels(maps), maps), start=1):
        ok = (room[at] >= n) & held(np.frombuffer(frequent.value, np.uint8), key)
        at, key = at[ok], key[ok]
        if not len(at):
            continue
        numbers = np.sort((key & ~low) | at.astype(np.uint64))
        place = (numbers & low).astype(np.int64)
        first = np.append(True, (numbers[1:] ^ numbers[:-1]) > low)
        head = place[np.flatnonzero(first)][np.cumsum(first) - 1]
        other = lang[place] != lang[head]
        for i in range(n):
            other |= words.codes[place + i] != words.codes[head + i]
        if other.any():  # a place that stands alone, and what then follows under the same key
            first |= other | np.append(False, other[:-1])
        first = np.flatnonzero(first)
        full = np.zeros(len(words.codes), np.uint64)
        full[at] = key
        found.append((place[first], np.full(len(first), n), np.add.reduceat(words.weights(place), first), full[place[first]]))
    if not found:
        return
    place, length, f, key = (np.concatenate(x) for x in zip(*found))
    group = bucket_of(key).astype(np.int64) * len(words.langs) + lang[place]
    order = np.argsort(group, kind="stable")
    group, f = group[order], f[order]
    data, offsets = words.phrases(place[order], length[order])
    first = np.flatnonzero(np.diff(group, prepend=-1))
    rows = np.append(first, len(group))
    yield pa.RecordBatch.from_arrays(
        [pa.array((group[first] // len(words.langs)).astype(np.int32)),
         pa.array([words.langs[i] for i in group[first] % len(words.langs)], pa.string()),
         blobs(data, offsets[rows]), blobs(f, rows)], ["bucket", "lang", "phrases", "f"])


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of every candidate.
    ``frequent`` is spooled; ``totals`` has (lang, n)."""
    word = F.split("phrase", " ")
    cut = (frequent.where("words >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
           .select("lang", "phrase", "words", F.col("f").alias("a"), "k",
                   F.array_join(F.slice(word, F.lit(1), F.col("k")), " ").alias("left"),
                   F.array_join(F.slice(word, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right")))
    left = again(frequent).select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = again(frequent).select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    ratio = F.expr("(1000 * cast(a as decimal(38,0)) * cast(n as decimal(38,0))) "
                   "div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    best = whole.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct(ratio.cast("long").alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")


def uncovered(candidates: DataFrame, frequent: DataFrame, cover: int = COVER) -> DataFrame:
    """Candidates that no longer candidate holds in ``cover`` percent of their
    places or more.  Those one word longer tell: what a still longer one
    covers, one of these, lying between, covers as well."""
    word = F.split("phrase", " ")
    longer = again(frequent).where("words >= 3").select(
        "lang", "f", F.explode(F.array(F.slice(word, F.lit(1), F.col("words") - 1),
                                       F.slice(word, F.lit(2), F.col("words") - 1))).alias("inside"))
    most = (longer.select("lang", F.array_join("inside", " ").alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("covered")))
    return candidates.join(most, ["lang", "phrase"], "left").where(
        F.col("covered").isNull() | (100 * F.col("covered") < cover * F.col("a"))).drop("covered")


@contextmanager
def narrow(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads and sends few rows at once; then the session is as before."""
    most = {"spark.sql.parquet.columnarReaderBatchSize": READ_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": SENT_BYTES}
    before = {key: spark.conf.get(key) for key in most}
    try:
        for key, value in most.items():
            spark.conf.set(key, value if before[key] == "-1" else min(value, _bytes(before[key])))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, cover: int = COVER,
         top: int = TOP, period: int = PERIOD) -> DataFrame:
    """The first ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    with narrow(docs.sparkSession):
        entries = spooled(packed_dictionary(docs, text_col, lang_col, period), "chunks")
        totals = spooled(words_of(again(entries)), "words")
        frequent = spooled(frequent_phrases(entries, least), "phrases")
        dropped(entries)
    found = uncovered(scored(frequent, totals), frequent, cover)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))
