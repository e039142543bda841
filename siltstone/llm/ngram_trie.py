"""N-gram language model in an Elias-Fano trie, learned and queried in shards.

Texts become blocks of some megabytes: token codes and the hashes of the block's distinct words. Each
level of the trie is built from what the blocks send to its shards (distinct n-grams with their counts),
and each shard answers every block from the level it has built, so that no task, broadcast or driver ever
holds a whole level. Messages are compressed arrays, one per block and shard.

Level 1 maps words to numbers, small for frequent words, and counts. On a level n above, an n-gram is a pair: the node of its first
n - 1 words and its last word. A shard holds contexts (sorted, Elias-Fano), pointers to the stretch of
their successors (monotone, Elias-Fano), the successors' numbers made monotone by adding what the stretch
before ended on (Elias-Fano), and bytes with quantised log probabilities and back-off weights. A query
finds its context, takes the stretch between two pointers, and searches the word relative to it. Levels
are files in the shared folder that shards map into memory.

Questions and answers are what the job writes most of, so neither says what the other side knows. A block repeats
its question when it reads the answers: these are a bit for each pair asked, and node and count of those that are kept,
of which the block computes the probability; the last level answers with the probability alone. Nodes are numbered
through by shard, and the shards of the next level take stretches of these numbers, so that steps from one
context to the next stay small however many shards there are.

Probabilities: level 1 has (c + 1) / (N + V + 1). An n-gram with count c, whose context has C, is kept if
the n-gram without its first word is, c >= `min_count`, and c * ln(c / E) - (c - E) >= `gain`. E = C * p is
what the level below expects of it, so that is the log likelihood gained by storing it (a Poisson
likelihood ratio): what the level below says as well, or what may be chance, is not stored. A `gain` of 0
stores every n-gram with the count. A kept n-gram has (c - `discount`) / C; the mass that is left over goes to the level below, normalised by what that level
gives to words that are not kept. Probabilities are stored to 1/20 of a decade.

A context with more than `HOT_SHARE` of all tokens (there can be 1 / HOT_SHARE of them at most) is spread
over all shards by its successors; its sums meet in one small table.

Nulls, blanks and ties: a null text is empty and consists of one end token; rows may repeat; null ids are
kept. If nothing is trained on, every token has probability 1. Empty tables give empty results.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.elias_fano import EliasFano
from siltstone.llm.packed import chunks, mixed, word_hashes, words
from siltstone.session import pin, scratch_path
from siltstone.sources.storage import remove_folder

BLOCK_BYTES = 6 << 20
SHARD_ENTRIES = 1_300_000
SENT_BYTES = 1 << 20
HOT_SHARE = 1e-3
START = 0  # number of the context before the first word; words are numbered from 1
_END = np.uint64(0x5D39E2B1C8A4F067)
# Settings of what is written as an intermediate table: shuffle files go as soon as it is written, and a task gets a
# block or some messages at a time, not all that fit into the usual 64 MB.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
_CODEC = pa.Codec("zstd", compression_level=3)


def _planes(a: np.ndarray) -> bytes:
    """Little-endian bytes by significance: the upper ones of small numbers are all alike and compress."""
    small = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
    return np.ascontiguousarray(small.view(np.uint8).reshape(len(small), small.itemsize).T).tobytes()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (not negative), compressed."""
    parts = [_planes(a) for a in arrays]
    head = np.array([x for a, p in zip(arrays, parts, strict=True) for x in (len(a), len(p))], dtype="<u4")
    raw = b"".join(parts)
    return len(arrays).to_bytes(1, "little") + head.tobytes() + _CODEC.compress(raw, asbytes=True)


def unpack(body: bytes) -> list[np.ndarray]:
    head = np.frombuffer(body[1 : 1 + 8 * body[0]], dtype="<u4").reshape(-1, 2).tolist()
    raw = np.frombuffer(_CODEC.decompress(body[1 + 8 * body[0] :], sum(p for _, p in head), asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for n, size in head:
        a = np.zeros(n, dtype=np.int64)
        for k, plane in enumerate(raw[at : at + size].reshape(size // n if n else 0, n)):
            a |= plane.astype(np.int64) << (8 * k)
        out.append(a)
        at += size
    return out


def to_code(p: np.ndarray) -> np.ndarray:
    """Probabilities as bytes, 20 steps a decade."""
    return np.clip(np.rint(-20 * np.log10(np.maximum(p, 1e-300))), 0, 255).astype(np.int64)


def from_code(code: np.ndarray) -> np.ndarray:
    """log10 of the coded probability."""
    return code / -20.0


def to_weight(b: np.ndarray) -> np.ndarray:
    """Back-off weights as bytes: 10^1 down to 10^-5.35, 40 steps a decade."""
    return np.clip(np.rint(40 * (1 - np.log10(np.maximum(b, 1e-300)))), 0, 254).astype(np.int64)


def from_weight(code: np.ndarray) -> np.ndarray:
    return 1 - code / 40.0


# ---- blocks ---------------------------------------------------------------------------------------


_BLOCK = "block bigint, doc_ids array<{kind}>, lengths binary, held binary, hashes binary, codes binary, by_hash binary, n_distinct bigint, n_tokens bigint, part int"


def make_blocks(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Blocks of (doc_id, text, held): per document its tokens, one end token last.

    Returns the blocks, their words' hashes, and the folder of both, which only level 1 reads.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            held = np.asarray(batch.column(2).fill_null(False)).astype(np.int64)
            for chunk in chunks(batch.column(1), BLOCK_BYTES, 1 << 16):
                w = words(chunk)
                rows = chunk.last - chunk.first
                h = np.insert(word_hashes(w), w.rows[1:], _END)
                distinct, codes, counts = np.unique(h, return_inverse=True, return_counts=True)
                # Codes by falling frequency: small numbers for frequent words.
                order = np.argsort(-counts, kind="stable")
                rank = np.empty(len(order), dtype=np.int64)
                rank[order] = np.arange(len(order))
                out_held = held[chunk.first : chunk.last]
                lengths = np.diff(w.rows) + 1
                times = np.bincount(codes[np.repeat(out_held == 0, lengths)], minlength=len(distinct))
                ids = pa.concat_arrays([batch.column(0).slice(chunk.first, rows), pa.nulls(0, batch.column(0).type)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block, block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, rows, rows], pa.int32()), ids),
                        *(pa.array(x, pa.binary()) for x in (
                            [pack(lengths), None], [pack(out_held), None], [None, distinct.tobytes()], [pack(rank[codes]), pack(times)], [pack(rank), None],
                        )),
                        pa.array([len(order), None], pa.int64()), pa.array([len(h), None], pa.int64()), pa.array([0, 1], pa.int32()),
                    ],
                    names=["block", "doc_ids", "lengths", "held", "hashes", "codes", "by_hash", "n_distinct", "n_tokens", "part"],
                )
                block += 1

    schema = _BLOCK.format(kind=kind)
    path = scratch_path(spark, "blocks")
    docs.select("doc_id", "text", "held").mapInArrow(run, schema).write.partitionBy("part").parquet(path)
    every = spark.read.schema(schema).parquet(path)
    hashes = every.filter("part = 1").select("block", "hashes", F.col("codes").alias("times"))
    return every.filter("part = 0").drop("part", "hashes"), hashes, path


@dataclass
class Block:
    codes: np.ndarray
    lengths: np.ndarray
    train: np.ndarray  # per token
    first: np.ndarray  # per token: first of its document


def _block(lengths: bytes, held: bytes, codes: bytes) -> Block:
    size, = unpack(lengths)
    kept, = unpack(held)
    first = np.zeros(int(size.sum()), dtype=bool)
    first[np.cumsum(size) - size] = True
    return Block(unpack(codes)[0], size, np.repeat(kept == 0, size), first)


# ---- messages -------------------------------------------------------------------------------------


_REQUEST = "shard int, block bigint, body binary"
_REPLY = "shard int, block bigint, body binary, tokens bigint, types bigint, level_file string, level_bytes bigint"


def _requests(frame: DataFrame, build: Callable[[tuple], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(shard, block, body) from rows whose first column is the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = tuple(c[k].as_py() for c in batch.columns)
                for sent in _shares(build(row), 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _ in sent], pa.int32()), pa.array([row[0]] * len(sent), pa.int64()), pa.array([b for _, b in sent], pa.binary())],
                        names=["shard", "block", "body"],
                    )
                del row
                pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, _REQUEST)


def _shares(rows: Iterator[tuple], body: int) -> Iterator[list[tuple]]:
    """The rows in lists of about SENT_BYTES of bodies (their column `body`), so that neither side of Arrow holds all."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[body] or b"")
        if size >= SENT_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _reply_table(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = ["shard", "block", "body", "tokens", "types", "level_file", "level_bytes"]
    return pa.Table.from_batches([
        pa.RecordBatch.from_arrays([pa.array([r[k] for r in share], t) for k, t in enumerate(types)], names=names) for share in _shares(rows, 2)
    ])


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers (not negative) in four bytes where they fit."""
    return a.astype(np.int32) if len(a) and int(a.max()) < 1 << 31 else a


def _stored(root: str, arrays: dict[str, np.ndarray]) -> tuple[str, dict[str, np.ndarray], int]:
    """Write a level's arrays to a file of its own and map the file into memory."""
    system, folder = pafs.FileSystem.from_uri(root)
    system.create_dir(folder, recursive=True)
    name = f"{folder}/{uuid.uuid4().hex}.level"
    places, at = {}, 0
    with system.open_output_stream(name, compression=None) as out:
        for key, a in arrays.items():
            raw = a.view(np.uint8).tobytes()
            out.write(raw + bytes(-len(raw) % 8))
            places[key] = (at, len(raw))
            at += len(raw) + -len(raw) % 8
    source = pa.memory_map(name) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(name)
    whole = np.frombuffer(source.read_buffer(at), dtype=np.uint8)
    return name, {key: whole[a : a + size] for key, (a, size) in places.items()}, at


def _narrow_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each, those from 255 on beside them."""
    return {"counts": np.minimum(counts, 255).astype(np.uint8), "large": counts[counts >= 255].astype(np.int64)}


def _counts(held: dict[str, np.ndarray]) -> np.ndarray:
    out = held["counts"].astype(np.int64)
    out[out == 255] = held["large"].view(np.int64)
    return out


def _by_shard(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every hash, in order of the hashes."""
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


# ---- level 1 --------------------------------------------------------------------------------------


def _ask_words(shards: int) -> Callable[[tuple], Iterator[tuple[int, bytes]]]:
    def build(row: tuple) -> Iterator[tuple[int, bytes]]:
        _, hashes, times = row
        h, counts = np.frombuffer(hashes, dtype=np.uint64), unpack(times)[0]
        shard = _by_shard(h, shards)
        for s in np.unique(shard).tolist():
            lo, hi = np.searchsorted(shard, [s, s + 1])
            yield s, int(hi - lo).to_bytes(4, "little") + h[lo:hi].tobytes() + pack(counts[lo:hi])

    return build


def _split_words(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of a message."""
    n = int.from_bytes(body[:4], "little")
    return np.frombuffer(body[4 : 4 + 8 * n], dtype=np.uint64), unpack(body[4 + 8 * n :])[0]


def _word_level(root: str, shards: int, min_count: int) -> Callable:
    """Merge counts, number the words, store the level and answer each block: number (0: none) and count."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        sent = [_split_words(b) for b in table.column("body").to_pylist()]
        h, place = np.unique(np.concatenate([x for x, _ in sent]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([c for _, c in sent]), minlength=len(h)).astype(np.int64)
        kept = np.flatnonzero(counts >= min_count)
        # Numbers by falling count: small ones for frequent words, which make up most of what is sent later.
        ranks = np.empty(len(kept), dtype=np.uint32)
        ranks[np.argsort(-counts[kept], kind="stable")] = np.arange(len(kept))
        name, arrays, size = _stored(root, {"words": EliasFano.encode(h[kept]), "ranks": ranks, **_narrow_counts(counts[kept])})
        known, kept_counts, ranks = EliasFano(arrays["words"]), _counts(arrays), arrays["ranks"].view(np.uint32).astype(np.int64)
        out = [(shard, -1, None, int(counts.sum()), int((counts > 0).sum()), name, size)]
        for block, (own, _) in zip(table.column("block").to_pylist(), sent, strict=True):
            at = np.minimum(known.successor(own), max(0, known.n - 1))
            found = known.access(at) == own if known.n else np.zeros(len(own), dtype=bool)
            total = np.where(found, kept_counts[at] if known.n else 0, counts[np.searchsorted(h, own)])
            out.append((shard, block, pack(np.packbits(found), ranks[at[found]], total), None, None, None, None))
        return _reply_table(out)

    return run


# ---- higher levels --------------------------------------------------------------------------------


def _bits(packed: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(packed.astype(np.uint8), count=n).astype(bool)


def _shard_of(context: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int, nodes: int) -> np.ndarray:
    """By context, words by their hash and `nodes` numbered through by stretches; hot contexts by context and word."""
    c = context.astype(np.uint64)
    spread = _by_shard(mixed(np.where(hot, mixed(c) + word.astype(np.uint64), c)), shards)
    return np.where(hot, spread, context * shards // nodes) if nodes else spread


def _groups(c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (c, w), and where a new pair begins in that order."""
    width = int(w.max()).bit_length() if len(w) else 0
    if len(c) and int(c.max()).bit_length() + width < 64:
        order = np.argsort((c << width) | w)
    else:
        order = np.lexsort((w, c))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (c[order][1:] != c[order][:-1]) | (w[order][1:] != w[order][:-1])
    return order, new


@dataclass
class Asked:
    """A block's question to a level: distinct (context, word) pairs and all other contexts, by shard."""

    tokens: np.ndarray  # tokens that ask
    pair: np.ndarray  # and the place of their pair
    some: np.ndarray  # per pair: a token that asks it
    c: np.ndarray
    w: np.ndarray
    shard: np.ndarray
    own: np.ndarray  # contexts without a pair, which still need their back-off weight; hot ones have it from elsewhere
    home: np.ndarray

    def shards(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """Per shard its pairs, where a new context begins among them, and its contexts without a pair."""
        every = np.union1d(self.shard, self.home)
        lo, hi = np.searchsorted(self.shard, every), np.searchsorted(self.shard, every, side="right")
        low, high = np.searchsorted(self.home, every), np.searchsorted(self.home, every, side="right")
        for s, a, b, x, y in zip(*(v.tolist() for v in (every, lo, hi, low, high)), strict=True):
            part = self.c[a:b]
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if b > a else np.zeros(0, dtype=np.int64)
            yield s, slice(a, b), heads, self.own[x:y]


def _asked(context: np.ndarray, count: np.ndarray, word: np.ndarray, ask: np.ndarray, hot_from: int, shards: int, nodes: int) -> Asked:
    """The question of a block's tokens, the same whenever it is put.

    context is a node (-1: none) with its count, word a number (0: none).
    """
    has = context >= 0
    ask = ask & has & (word > 0)
    tokens = np.flatnonzero(ask)
    order, new = _groups(context[tokens], word[tokens])
    tokens = tokens[order]
    some = tokens[new]
    c, w = context[some], word[some]
    shard = _shard_of(c, w, count[some] > hot_from, shards, nodes)
    by_shard = np.argsort(_narrow_shards(shard, shards), kind="stable")
    place = np.empty(len(by_shard), dtype=np.int64)
    place[by_shard] = np.arange(len(by_shard))
    own = np.unique(context[has & ~ask & (count <= hot_from)])
    if len(c):
        own = own[c[np.minimum(np.searchsorted(c, own), len(c) - 1)] != own]
    home = _shard_of(own, own, np.zeros(len(own), dtype=bool), shards, nodes)
    by_home = np.argsort(_narrow_shards(home, shards), kind="stable")
    return Asked(tokens, place[np.cumsum(new) - 1], some[by_shard], c[by_shard], w[by_shard], shard[by_shard], own[by_home], home[by_home])


def _narrow_shards(shard: np.ndarray, shards: int) -> np.ndarray:
    """Short numbers are sorted by digits."""
    return shard.astype(np.uint16) if shards < 1 << 16 else shard


def _ask_pairs(b: Block, a: Asked, count: np.ndarray, lp: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The question as messages, with how often a pair occurs in training and what the levels below say (`lp`)."""
    times = np.bincount(a.pair[b.train[a.tokens]], minlength=len(a.c))
    big, low = count[a.some], to_code(10.0 ** lp[a.some])
    for s, own, heads, more in a.shards():
        yield s, pack(
            np.diff(a.c[own][heads], prepend=0), np.diff(np.append(heads, own.stop - own.start)), big[own][heads], a.w[own], times[own], low[own],
            np.diff(more, prepend=0),
        )


def _pair_level(root: str, hot_from: int, min_count: int, discount: float, gain: float, last: bool) -> Callable:
    """Merge counts, prune, store the level and answer each block.

    The answer has a bit for each pair asked (is it kept?) and for each context asked (has it a back-off weight?), the weights,
    and of the pairs that are kept node and count, on the last level the code of their probability instead.
    The row with block -1 reports the sums of hot contexts.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        blocks, bodies = table.column("block").to_pylist(), table.column("body")
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for body in bodies:
            gaps, runs, heads, word, times, low, _ = unpack(body.as_py())
            for held, a in zip(
                parts, (np.repeat(np.cumsum(gaps), runs), np.repeat(_narrow(heads), runs), _narrow(word), _narrow(times), low.astype(np.uint8)), strict=True
            ):
                held.append(a)
        for k in range(len(parts)):  # one after the other, so that a column is there twice, not all
            parts[k] = np.concatenate(parts[k])
        c, big, w, times, low = parts
        del parts
        order, new = _groups(c, w)
        first = np.flatnonzero(new)
        total = np.add.reduceat(times[order], first, dtype=np.int64) if len(first) else times.astype(np.int64)
        some = order[first]
        c, big, w, low_p = c[some], np.maximum(big[some].astype(np.int64), 1), w[some].astype(np.int64), 10.0 ** from_code(low[some].astype(np.int64))
        del times, low, order, new, first, some
        expected = big * low_p
        more = total * np.log(np.maximum(total / expected, 1.0)) - np.maximum(total - expected, 0)
        kept = np.flatnonzero((total >= min_count) & ((more >= gain) | (gain <= 0)))
        c, big, w, total, low_p = c[kept], big[kept], w[kept], total[kept], low_p[kept]
        del expected, more, kept
        p = (total - discount) / big
        heads = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, dtype=np.int64)
        contexts, sums = c[heads], np.add.reduceat(p, heads) if len(c) else p
        lows = np.add.reduceat(low_p, heads) if len(c) else p
        ends = np.append(heads, len(c))
        # Successors relative to the end of the stretch before make one monotone sequence.
        shift = np.concatenate([[0], np.cumsum(w[ends[1:] - 1])[:-1]]) if len(c) else np.zeros(0, dtype=np.int64)
        hot = big[heads] > hot_from
        weight = np.where(hot, 255, to_weight(np.maximum(1 - sums, 1e-6) / np.maximum(1 - lows, 1e-3)))
        name, held, size = _stored(root, {
            "contexts": EliasFano.encode(contexts), "pointers": EliasFano.encode(ends), "successors": EliasFano.encode(w + np.repeat(shift, np.diff(ends))),
            "codes": to_code(p).astype(np.uint8), "weights": weight.astype(np.uint8), **_narrow_counts(total),
        })
        level = Stored(held, _sieve(c, w))
        out = [(shard, -1, pickle.dumps((contexts[hot], sums[hot], lows[hot]), protocol=5), 0, len(c), name, size)]
        for block, body in zip(blocks, bodies, strict=True):
            gaps, runs, _, word, _, _, more = unpack(body.as_py())
            out.append((shard, block, level.answer(np.cumsum(gaps), runs, word, np.cumsum(more), last), None, None, None, None))
        pa.default_memory_pool().release_unused()
        return _reply_table(out)

    return run


def _place(c: np.ndarray, w: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    mixed_up = c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed_up >> np.uint64(65 - len(sieve).bit_length())).astype(np.int64)


def _sieve(c: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A bit for every pair by its hash, about one in sixteen set: pairs that miss it are not there."""
    sieve = np.zeros(1 << max(10, (16 * len(c)).bit_length()), dtype=bool)
    sieve[_place(c, w, sieve)] = True
    return sieve


class Stored:
    """One shard of a level above the first, over memory-mapped arrays."""

    def __init__(self, held: dict[str, np.ndarray], sieve: np.ndarray | None = None):
        self._sieve = sieve
        self.contexts, self.pointers, self.successors = (EliasFano(held[k]) for k in ("contexts", "pointers", "successors"))
        pad = np.zeros(1, dtype=np.int64)
        self.codes = np.append(held["codes"], np.uint8(0)).astype(np.int64)
        self.counts = np.append(_counts(held), pad)
        self.weights = np.append(held["weights"], np.uint8(0)).astype(np.int64)

    def _context(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.contexts.n:
            return np.zeros(len(c), dtype=np.int64), np.zeros(len(c), dtype=bool)
        at = np.minimum(self.contexts.successor(c), self.contexts.n - 1)
        return at, self.contexts.access(at) == c.astype(np.uint64)

    def _stretch(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pointers.access(at).astype(np.int64), self.pointers.access(at + 1).astype(np.int64)

    def successors_of(self, first: np.ndarray, last: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Place of the word in each stretch, -1 if it is not there: a search relative to the stretch."""
        base = np.where(first > 0, self.successors.access(np.maximum(first - 1, 0)), 0).astype(np.uint64)
        wanted = base + w.astype(np.uint64)
        place = self.successors.successor(wanted, first, last)
        inside = place < last
        inside[inside] = self.successors.access(place[inside]) == wanted[inside]
        return np.where(inside, place, -1)

    def find(self, c: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Node of every (context, word), -1 if it is not kept."""
        at, known = self._context(c)
        out = np.full(len(c), -1, dtype=np.int64)
        ask = np.flatnonzero(known)
        if len(ask):
            out[ask] = self.successors_of(*self._stretch(at[ask]), w[ask])
        return out

    def answer(self, heads: np.ndarray, runs: np.ndarray, w: np.ndarray, more: np.ndarray, last: bool) -> bytes:
        """Which pairs are kept, given by context (`heads`, each for a run of words), and back-off weights."""
        at, known = self._context(heads)
        ask = np.repeat(known, runs)
        if self._sieve is not None:  # most pairs that are not kept need no search
            ask &= self._sieve[_place(np.repeat(heads, runs), w, self._sieve)]
        head, word = np.repeat(np.arange(len(heads)), runs)[ask], w[ask]
        if len(word):
            first, end = self._stretch(at[known])
            rank = np.cumsum(known) - 1
            node = self.successors_of(first[rank[head]], end[rank[head]], word)
        else:
            node = np.zeros(0, dtype=np.int64)
        hit = node >= 0
        ask[ask] = hit
        node = node[hit]
        other, also = self._context(more)
        weight = self.weights[np.concatenate([at, other])]
        given = np.concatenate([known, also]) & (weight < 255)
        # Contexts and nodes rise, so that their steps are small.
        told = [self.codes[node]] if last else [np.diff(node, prepend=0), self.counts[node]]
        return pack(np.packbits(ask), np.packbits(given), weight[given], *told)


def _words_of(replies: list[tuple[int, bytes]], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (0: none) and counts of a block's words in the order of their hashes."""
    numbers, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for shard, body in sorted(replies):
        found, ranks, total = unpack(body)
        number = np.zeros(len(total), dtype=np.int64)
        number[_bits(found, len(total))] = ranks * shards + shard + 1
        numbers.append(number)
        counts.append(total)
    return np.concatenate(numbers), np.concatenate(counts)


@dataclass
class Kept:
    """What a level answered: per pair asked whether it is kept, and if so node, count and code; contexts and their weights."""

    found: np.ndarray
    node: np.ndarray
    count: np.ndarray
    code: np.ndarray
    own: np.ndarray
    weight: np.ndarray


def _kept_of(a: Asked, replies: list[tuple[int, bytes]], big: np.ndarray, starts: np.ndarray, discount: float) -> Kept:
    """The answers to a question, of whose pairs `big` is the context's count; `starts` has the shards' first nodes."""
    n, bodies = len(a.c), dict(replies)
    out = Kept(np.zeros(n, dtype=bool), np.full(n, -1, dtype=np.int64), *np.zeros((2, n), dtype=np.int64), *np.zeros((2, 0), dtype=np.int64))
    contexts, weights = [out.own], [out.weight]
    for s, own, heads, more in a.shards():
        kept, given, weight, *told = unpack(bodies[s])
        found = _bits(kept, own.stop - own.start)
        at = np.flatnonzero(found) + own.start
        if len(told) == 1:
            out.code[at] = told[0]
        else:
            out.node[at], out.count[at] = np.cumsum(told[0]) + starts[s], told[1]
            out.code[at] = to_code((told[1] - discount) / np.maximum(big[at], 1))
        out.found[own] = found
        asked = np.concatenate([a.c[own][heads], more])
        contexts.append(asked[_bits(given, len(asked))])
        weights.append(weight)
    out.own, out.weight = np.concatenate(contexts), np.concatenate(weights)
    return out


def _look_up(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each asked value a place in `keys` (any order), and whether it is there."""
    order = np.argsort(keys)
    at = np.minimum(np.searchsorted(keys[order], asked), len(keys) - 1)
    at = order[at]
    return at, keys[at] == asked


@dataclass
class Run:
    """What is known once the words are counted."""

    tokens: int
    types: int
    docs: int
    word_shards: int
    discount: float
    pair_shards: list[int]
    starts: list[np.ndarray]  # per level above the first: the number of each shard's first node, and last of all nodes
    hot: list[dict[int, float]]  # per level above the first: log10 back-off weight of hot contexts

    @property
    def hot_from(self) -> int:
        return max(1, int(HOT_SHARE * self.tokens))

    def asked(self, k: int, context: np.ndarray, count: np.ndarray, word: np.ndarray, ask: np.ndarray) -> Asked:
        """The question to the k-th level above the first."""
        return _asked(context, count, word, ask, self.hot_from, self.pair_shards[k], int(self.starts[k - 1][-1]) if k else 0)


def _replayed(run: Run, lengths: bytes, held: bytes, codes: bytes, names: bytes, replies: list) -> tuple:
    """Token states of a block after the levels above the first answered so far.

    (block, counts of words, log10 p, context node, its count, word number, is the longest n-gram kept)
    """
    b = _block(lengths, held, codes)
    number, count = unpack(names)  # by code
    c, word = count[b.codes], number[b.codes]
    lp = np.log10((count + 1) / (run.tokens + run.types + 1))[b.codes]
    context, context_count = np.roll(word, 1), np.roll(c, 1)
    context[context == 0] = -1
    context[b.first], context_count[b.first] = START, run.docs
    hit = word > 0
    for k, answers in enumerate(replies):
        # As usual in such tries, an n-gram is kept only if the n-gram without its first word is.
        asked = run.asked(k, context, context_count, word, hit)
        kept = _kept_of(asked, answers, context_count[asked.some], run.starts[k], run.discount)
        hot = np.array(sorted(run.hot[k]), dtype=np.int64)
        own = np.concatenate([kept.own, hot])
        shift = np.concatenate([from_weight(kept.weight), np.array([run.hot[k][x] for x in hot.tolist()])])
        back = np.zeros(len(word))
        if len(own) and k == 0:  # contexts are words: look up each distinct one once
            weights = np.zeros(len(number) + 1)
            values = np.append(number, START)
            values[:-1][number == 0] = -1
            at, found = _look_up(own, values)
            weights[found] = shift[at[found]]
            before = np.roll(b.codes, 1)
            before[b.first] = len(number)
            back = weights[before]
        elif len(own):
            having = np.flatnonzero(context >= 0)
            at, found = _look_up(own, context[having])
            back[having[found]] = shift[at[found]]
        lp = lp + back
        hit, after, total = np.zeros(len(word), dtype=bool), np.full(len(word), -1, dtype=np.int64), np.zeros(len(word), dtype=np.int64)
        found = kept.found[asked.pair]
        tokens, pair = asked.tokens[found], asked.pair[found]
        hit[tokens], lp[tokens], after[tokens], total[tokens] = True, from_code(kept.code[pair]), kept.node[pair], kept.count[pair]
        # The node of this n-gram is the context of the next word.
        context, context_count = np.roll(after, 1), np.roll(total, 1)
        context[b.first] = -1
    return b, c, lp, context, context_count, word, hit


def _gathered(replies: DataFrame, name: str) -> DataFrame:
    """(block, name): a level's answers to each block, as an array of (shard, body)."""
    return replies.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "body")).alias(name))


_NAMED = "block bigint, doc_ids array<{kind}>, lengths binary, held binary, codes binary, names binary"


def _named(blocks: DataFrame, replies: DataFrame, shards: int) -> DataFrame:
    """Blocks with the numbers and counts of their words, by code, dealt out by block once and for all.

    They are kept in buckets of the block's number, so that later levels bring their answers to the blocks and
    the blocks stay where they are.
    """
    spark = blocks.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for order, answers in zip(batch.column("by_hash"), batch.column("level"), strict=True):
                by_hash = unpack(order.as_py())[0]  # codes in order of their hashes
                number, count = np.zeros(len(by_hash), dtype=np.int64), np.zeros(len(by_hash), dtype=np.int64)
                number[by_hash], count[by_hash] = _words_of(_pairs_of(answers.as_py()), shards)
                names.append(pack(number, count))
            columns = [batch.column(c) for c in ("block", "doc_ids", "lengths", "held", "codes")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.binary())], names=["block", "doc_ids", "lengths", "held", "codes", "names"])

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.select("block", "doc_ids", "lengths", "held", "codes", "by_hash").repartition(count, "block")
    joined = dealt.join(_gathered(replies, "level"), "block", "left")
    schema = _NAMED.format(kind=blocks.schema["doc_ids"].dataType.elementType.simpleString())
    path = scratch_path(spark, "named")
    table = f"named_{uuid.uuid4().hex}"
    joined.mapInArrow(run, schema).write.bucketBy(count, "block").option("path", path).saveAsTable(table)
    return spark.table(table)


def _dealt(replies: DataFrame, name: str) -> DataFrame:
    """A level's answers in buckets of the block's number, like the blocks themselves: later levels read them in place."""
    spark = replies.sparkSession
    table = f"answers_{uuid.uuid4().hex}"
    gathered = _gathered(replies, name).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    gathered.option("path", scratch_path(spark, "answers")).saveAsTable(table)
    return spark.table(table)


def _with_replies(blocks: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Named blocks with the answers of every level above the first, by block."""
    out = blocks
    for answers in levels:
        out = out.join(answers, "block", "left")
    return out


_SCORE = "doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def score(
    docs: DataFrame, *, order: int = 3, min_count: int = 2, discount: float = 0.5, gain: float = 0.0, text: str = "text", doc_id: str = "doc_id",
    held_out: str = "held_out", root: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Learn from the rows that are not `held_out` (boolean) and score all rows.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row, and the files of
    the trie's levels (level, shard, level_file, level_bytes, types). `base_score` is the add-one unigram score.
    """
    spark = docs.sparkSession
    root = root or scratch_path(spark, "trie")
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(held_out), F.lit(False)).alias("held"))
    blocks, hashes, blocks_path = make_blocks(named)
    distinct, tokens = blocks.agg(F.sum("n_distinct"), F.sum("n_tokens")).first()
    word_shards = 1 + int(distinct or 0) // SHARD_ENTRIES
    asked = _requests(hashes, _ask_words(word_shards))
    words_path = scratch_path(spark, "words")
    with _writing(spark):
        asked.groupBy("shard").applyInArrow(_word_level(f"{root}/1", word_shards, min_count), _REPLY).write.parquet(words_path)
    answers = spark.read.schema(_REPLY).parquet(words_path)
    reports_1 = pin(answers.filter("block < 0").drop("body"), "words")
    trained = reports_1.agg(F.sum("tokens"), F.sum("types")).first()
    remove_folder(spark, f"{blocks_path}/part=1")  # the hashes are answered
    with _writing(spark):
        blocks = _named(blocks, answers, word_shards)
    for path in (blocks_path, words_path):  # all that is needed of them is with the named blocks
        remove_folder(spark, path)
    train_docs = named.filter(~F.col("held")).count()
    state = Run(int(trained[0] or 0), int(trained[1] or 0), train_docs, word_shards, discount, [], [], [])
    answered: list[DataFrame] = []
    made: list[DataFrame] = []

    pairs = int(tokens or 0)
    for k in range(2, order + 1):
        shards = 1 + pairs // SHARD_ENTRIES
        state.pair_shards.append(shards)
        fixed = replace(state, pair_shards=[*state.pair_shards], starts=[*state.starts], hot=[*state.hot])

        def build(row: tuple, run: Run = fixed) -> Iterator[tuple[int, bytes]]:
            _, _, lengths, held, codes, names, *answers = row
            b, _, lp, context, count, word, hit = _replayed(run, lengths, held, codes, names, [_pairs_of(a) for a in answers])
            yield from _ask_pairs(b, run.asked(len(answers), context, count, word, hit), count, lp)

        asked = _requests(_with_replies(blocks, answered), build)
        level = _pair_level(f"{root}/{k}", state.hot_from, min_count, discount, gain, k == order)
        pairs_path = scratch_path(spark, "pairs")
        with _writing(spark):
            asked.groupBy("shard").applyInArrow(level, _REPLY).write.parquet(pairs_path)
        replies = spark.read.schema(_REPLY).parquet(pairs_path)
        made.append(pin(replies.filter("block < 0").select("shard", "level_file", "level_bytes", "types"), "reports"))
        reports = replies.filter("block < 0").select("shard", "body", "types").collect()  # a row per shard
        sums: dict[int, list[float]] = {}
        starts = np.zeros(shards + 1, dtype=np.int64)
        for r in reports:
            starts[r["shard"] + 1] = r["types"] or 0
            for c, p, low in zip(*(x.tolist() for x in pickle.loads(r["body"])), strict=True):
                held_ = sums.setdefault(c, [0.0, 0.0])
                held_[0] += p
                held_[1] += low
        state.starts.append(np.cumsum(starts))
        state.hot.append({c: float(np.log10(max(1 - p, 1e-6) / max(1 - low, 1e-3))) for c, (p, low) in sums.items()})
        pairs = min(pairs, 4 * int(state.starts[-1][-1]) + SHARD_ENTRIES)
        if k == order:  # read once, by the scores
            answered.append(_gathered(replies, f"level{k}"))
            continue
        with _writing(spark):
            answered.append(_dealt(replies, f"level{k}"))
        remove_folder(spark, pairs_path)
    final = state

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, _, lengths, held, codes, names, *answers = (c[k].as_py() if j != 1 else None for j, c in enumerate(batch.columns))
                b, c, lp, *_ = _replayed(final, lengths, held, codes, names, [_pairs_of(a) for a in answers])
                doc = np.repeat(np.arange(len(b.lengths)), b.lengths)
                n = len(b.lengths)
                base = np.log10((c + 1) / (final.tokens + final.types + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[k].values, pa.array(~b.train[np.cumsum(b.lengths) - b.lengths]), pa.array(b.lengths),
                        pa.array(np.bincount(doc, weights=c > 0, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(doc, weights=base, minlength=n)), pa.array(np.bincount(doc, weights=lp, minlength=n)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    with _writing(spark):
        scored = pin(_with_replies(blocks, answered).mapInArrow(finish, _SCORE.format(kind=kind)), "scored")
    scored = scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(final.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
    files = None
    for k, r in enumerate([reports_1, *made]):
        own = r.select(F.lit(k + 1).alias("level"), "shard", "level_file", "level_bytes", "types")
        files = own if files is None else files.union(own)
    return scored, files


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """`_WHILE_WRITING` holds for what is written inside."""
    before = {key: spark.conf.get(key, None) for key in _WHILE_WRITING}
    for key, value in _WHILE_WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _pairs_of(answers: list | None) -> list[tuple[int, bytes]]:
    return [(a["shard"], a["body"]) for a in answers or []]
