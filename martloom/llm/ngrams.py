"""Language-model scores by a weighted backoff automaton.

Counts of words, of word pairs and, at order three, of triples are gathered over all training rows. A context's continuation is smoothed
towards the word's own probability as if `strength` imagined tokens had been drawn from it,

    p(w | h) = (c(h w) + strength * p(w)) / (c(h) + strength),    p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)),

which sums to one for every context and has the form of a backoff: a pair that was seen is an arc with its own
weight; any other word is reached over the failure arc of the context, whose weight is that of the
imagined tokens, and the word's arc at the root. At order three p(w | u v) is smoothed towards p(w | v) alike: a
pair that was seen is a state, which fails to that of its second word.

No task holds the whole model. Texts are stored in blocks of bounded size as local word numbers. Each
block asks for the counts of its words and pairs; the requests are dealt to buckets by hash, summed there and answered. With
the answers a block builds the part of the automaton that its texts can reach, and walks it. Words
are counted as words; pairs and triples are told apart by their bucket and 48 more bits of a hash. A block asks for a triple
only when both of its pairs were learned from and asked for by other blocks too; in all other cases its own count is the whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import byte_texts, fold_of, word_runs
from martloom.storage import release_shuffles, store

#: Imagined tokens per context.
STRENGTH = 10.0
#: Bytes of text in a block (a longer text is a block by itself), and tokens whose requests are summed in one bucket.
BLOCK_BYTES = 4 << 20
BUCKET_REQUESTS = 2_000_000

#: Bytes of the hash of a pair or triple that are sent; its bucket tells it apart as well.
KEY_BYTES = 6

END = 0  # local number of the end token; words count from 1
ROOT = 0


def planes(numbers: np.ndarray) -> bytes:
    """Numbers with their lowest bytes first, then all second bytes and so on: small ones compress to little."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


@dataclass
class Block:
    lengths: np.ndarray  # tokens of each text, its end included
    trained: np.ndarray  # whether each text is learned from
    ids: np.ndarray  # local numbers of all tokens
    words: list[bytes]  # words in order of their local numbers, the end as an empty word before them

    @staticmethod
    def read(lengths: bytes, trained: bytes, ids: bytes, words: bytes) -> Block:
        return Block(
            np.frombuffer(lengths, np.int64), np.frombuffer(trained, np.bool_), from_planes(unpacked(ids), np.int32), unpacked(words).split(b"\n")
        )

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))

    def word_counts(self) -> np.ndarray:
        learned = self.ids[np.repeat(self.trained, self.lengths)]
        return np.bincount(learned, minlength=len(self.words))

    def learned(self) -> np.ndarray:
        """Whether each token is of a text that is learned from."""
        return np.repeat(self.trained, self.lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different pairs of the block, as first * words + second, how often the learned texts have each, and for each token
        the place of the pair that it ends, -1 for the first of a text."""
        at = np.full(len(self.ids), -1, np.int64)
        inner = np.flatnonzero(self.ids[:-1] != END) + 1
        values = self.ids[inner - 1].astype(np.int64) * len(self.words) + self.ids[inner]
        codes, counts, at[inner], _ = distinct(values, self.learned()[inner])
        return codes, counts, at

    def pair_hashes(self, codes: np.ndarray) -> np.ndarray:
        h, n = self.hashes(), np.int64(len(self.words))
        return mixed(h[codes // n], h[codes % n])

    def triples(self, pair_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different triples, as place of the first two among the pairs * words + third, how often the learned texts have each, for each
        token the place of the triple that it ends, or -1, and the place of the last two words of each triple."""
        at = np.full(len(self.ids), -1, np.int64)
        inner = np.flatnonzero((pair_at[:-1] >= 0) & (pair_at[1:] >= 0)) + 1
        values = pair_at[inner - 1] * np.int64(len(self.words)) + self.ids[inner]
        codes, counts, at[inner], first = distinct(values, self.learned()[inner])
        return codes, counts, at, pair_at[inner][first]

    def asked(self, totals: np.ndarray, alone: np.ndarray, triples: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which triples may have counts in other blocks."""
        open_pair = (totals > 0) & ~alone
        return open_pair[triples // np.int64(len(self.words))] & open_pair[last]

    def triple_hashes(self, pairs: np.ndarray, triples: np.ndarray) -> np.ndarray:
        n = np.int64(len(self.words))
        return mixed(self.pair_hashes(pairs)[triples // n], self.hashes()[triples % n])


def distinct(values: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different values in order, how many of each are learned, the place of each value among them, and where each is found."""
    if not len(values):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    order = np.argsort(values)
    ordered = values[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    places = np.empty(len(values), np.int64)
    places[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], np.add.reduceat(learned[order].astype(np.int64), first), places, order[first]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def keys_of(hashes: np.ndarray, buckets: int) -> bytes:
    """What is left of each hash once its bucket is known, in KEY_BYTES bytes."""
    rest = (hashes // np.uint64(buckets)).astype("<u8")
    return np.ascontiguousarray(rest.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def from_keys(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return wide.view("<u8").reshape(-1)


def dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of requests by bucket, and where each bucket begins in it (one more than there are)."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


#: Stands for the weight of an arc that is not there; weights are logarithms of probabilities and not above 0.
NO_ARC = 1.0


@dataclass
class Automaton:
    """States with arcs, failure arcs, and the weights of both; all weights are log10 of probabilities.

    The root is state 0 and has an arc for every word. Word w is state w + 1 where it was learned, and has an arc for each pair that
    begins with it; a pair is a state above those of words, and has an arc for each triple.
    Pairs fail to their second word, words to the root.
    """

    own: np.ndarray  # arcs of the root by word: weights, and the states they lead to
    state: np.ndarray
    codes: np.ndarray  # pairs as first * words + second, in order
    pair_weight: np.ndarray
    pair_state: np.ndarray
    triples: np.ndarray  # place of the first two words among the pairs * words + third, in order
    triple_weight: np.ndarray
    backoff: list[float]  # by state
    failure: list[int]

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some tokens of one text the place of the pair and of the triple that it ends, or -1."""

        def find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
            at = np.searchsorted(known, values)
            found = known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)
            return np.where(found, at, -1)

        n, none = np.int64(len(self.own)), np.full(1, -1)
        pair_at = np.append(none, find(self.codes, ids[:-1] * n + ids[1:]))[: len(ids)]
        before = pair_at[:-1]
        triple_at = np.append(none, np.where(before >= 0, find(self.triples, before * n + ids[1:]), -1))[: len(ids)]
        return pair_at, triple_at

    def walk(self, ids: np.ndarray, pair_at: np.ndarray, triple_at: np.ndarray) -> float:
        """The weight of one traversal from the root, left to right; at each token the longest context's arc, or a failure arc."""

        def of(table: np.ndarray, at: np.ndarray, none: float) -> list:
            return (np.where(at >= 0, table[at], none) if len(table) else np.full(len(at), none)).tolist()

        words, backoff, failure = len(self.own), self.backoff, self.failure
        arcs = zip(
            self.own[ids].tolist(), self.state[ids].tolist(), of(self.pair_weight, pair_at, NO_ARC),
            of(self.pair_state, pair_at, ROOT), of(self.triple_weight, triple_at, NO_ARC),
        )
        state, total = ROOT, 0.0
        for own, word, pair, goal, triple in arcs:
            if state > words:
                if triple <= 0.0:
                    total += triple
                    state = goal
                    continue
                total += backoff[state]
                state = failure[state]
            if state:
                if pair <= 0.0:
                    total += pair
                    state = goal
                    continue
                total += backoff[state]
            total += own
            state = word
        return total


def automaton(
    counts: np.ndarray,
    total: int,
    different: int,
    codes: np.ndarray,
    pair_counts: np.ndarray,
    strength: float,
    triples: np.ndarray | None = None,
    triple_counts: np.ndarray | None = None,
    last_pairs: np.ndarray | None = None,
) -> Automaton:
    """The automaton over local words from their corpus counts and those of the pairs, and triples, among them.

    A word that was learned is a state, numbered one after the word; all others lead back to the root. With
    triples a pair that was learned is a state too, unless it ends a text.
    """
    n = len(counts)
    own = (counts + 0.5) / (total + 0.5 * (different + 1))
    state = np.where(counts > 0, np.arange(n) + 1, ROOT)
    backoff, failure = [np.zeros(1), np.log10(strength / (counts + strength))], [np.zeros(n + 1, np.int64)]
    first, second = codes // n, codes % n
    seen = pair_counts > 0
    p_pair = (pair_counts + strength * own[second]) / (counts[first] + strength)
    goal = np.where(seen, state[second], ROOT)
    triple_weight = np.zeros(0)
    if triples is not None:
        inner = seen & (second != END)
        goal = np.where(inner, n + np.cumsum(inner), goal)
        backoff.append(np.log10(strength / (pair_counts[inner] + strength)))
        failure.append(state[second[inner]])
        before = triples // n
        p = (triple_counts + strength * p_pair[last_pairs]) / (pair_counts[before] + strength)
        triple_weight = np.where(triple_counts > 0, np.log10(p), NO_ARC)
    return Automaton(
        own=np.log10(own),
        state=state,
        codes=codes,
        pair_weight=np.where(seen, np.log10(p_pair), NO_ARC),
        pair_state=goal,
        triples=np.zeros(0, np.int64) if triples is None else triples,
        triple_weight=triple_weight,
        backoff=np.concatenate(backoff).tolist(),
        failure=np.concatenate(failure).tolist(),
    )


def _blocks(docs: DataFrame, key: str, text: str, block_bytes: int) -> DataFrame:
    rows = docs.select(docs[key].alias("key"), (fold_of(docs[key]) != 1).alias("trained"), docs[text].alias("text"))

    def encode(batches):
        keys, lengths, trained, parts, size, known = [], [], [], [], 0, {b"": END}

        def made():
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            data = [np.array(lengths, np.int64).tobytes(), np.array(trained, np.bool_).tobytes(), packed(planes(ids)), packed(b"\n".join(known))]
            columns = [pa.array([keys], pa.list_(kind)), *[pa.array([x], pa.binary()) for x in data], pa.array([len(ids)], pa.int64())]
            return pa.record_batch(columns, ["keys", "lengths", "trained", "ids", "words", "tokens"])

        for batch in batches:
            kind = batch.schema.field("key").type
            for k, t, data in zip(batch.column("key").to_pylist(), batch.column("trained").to_pylist(), byte_texts(batch)):
                n = 0
                for words in word_runs(data, bytes.lower):
                    for w in set(words).difference(known):
                        known[w] = len(known)
                    parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                    n += len(words)
                parts.append(np.array([END], np.int32))
                keys.append(k)
                trained.append(t)
                lengths.append(n + 1)
                size += len(data) + 1
                if size >= block_bytes:
                    yield made()
                    keys, lengths, trained, parts, size, known = [], [], [], [], 0, {b"": END}
        if keys:
            yield made()

    own = rows.schema["key"].dataType.simpleString()
    layout = f"keys ARRAY<{own}>, lengths BINARY, trained BINARY, ids BINARY, words BINARY, tokens BIGINT"
    return rows.mapInArrow(encode, layout)


_PARTS = "bucket INT, block BIGINT, words BINARY, pairs BINARY, counts BINARY"


_NAMES = ["bucket", "block", "words", "pairs", "counts"]
_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _packed(block: int, words: list[bytes] | None, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row per bucket that the block asks, by words or else by hashes; a bucket that it asks nothing has none."""
    order, starts = dealt(hashes, buckets)
    counts, hashes = counts[order].astype(np.int64), hashes[order]
    rows = []
    for b in np.flatnonzero(np.diff(starts)).tolist():
        part = slice(starts[b], starts[b + 1])
        asked = [None, keys_of(hashes[part], buckets)] if words is None else [packed(b"\n".join([words[i] for i in order[part].tolist()])), None]
        rows.append((b, block, *asked, planes(counts[part])))
    return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, _TYPES)], _NAMES)


def _requests(blocks: DataFrame, buckets: int, of_pairs: bool) -> DataFrame:
    """A row per block and bucket: what the block asks about, and its own counts."""

    def ask(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row["lengths"], row["trained"], row["ids"], row["words"])
                if of_pairs:
                    codes, counts, _ = block.pairs()
                    hashes = block.pair_hashes(codes)
                else:
                    counts, hashes = block.word_counts(), block.hashes()
                yield _packed(row["block"], None if of_pairs else block.words, hashes, counts, buckets)

    return blocks.select("block", "lengths", "trained", "ids", "words").mapInArrow(ask, _PARTS)


_ANSWERS = "block BIGINT, bucket INT, totals BINARY, learned BIGINT, different BIGINT"


def _answers(requests: DataFrame, of_pairs: bool) -> DataFrame:
    """A row per request with the counts of all blocks together, in the order asked.

    For words also a row per bucket under block -1: tokens learned, and different ones among them. For pairs and
    triples the counts are doubled, and one more where no other request has the same.
    """

    def answer(table: pa.Table) -> pa.Table:
        counts = [from_planes(x, np.int64) for x in table.column("counts").to_pylist()]
        if of_pairs:
            keys = np.concatenate([from_keys(x) for x in table.column("pairs").to_pylist()])
            _, place = np.unique(keys, return_inverse=True)
        else:
            words = pa.array([w for x in table.column("words").to_pylist() for w in unpacked(x).split(b"\n")], pa.binary())
            place = words.dictionary_encode().indices.to_numpy()
        totals = np.bincount(place, np.concatenate(counts)).astype(np.int64)
        if of_pairs:
            totals = 2 * totals + (np.bincount(place) == 1)
        ends = np.cumsum([len(c) for c in counts])
        answers = pa.array([planes(totals[place[e - len(c) : e]]) for c, e in zip(counts, ends)], pa.binary())
        columns = {
            "block": table.column("block").combine_chunks(),
            "bucket": table.column("bucket").combine_chunks(),
            "totals": answers,
            "learned": pa.nulls(len(counts), pa.int64()),
            "different": pa.nulls(len(counts), pa.int64()),
        }
        whole = [-1, None, None, int(totals.sum()), int((totals > 0).sum())]
        if not of_pairs:
            columns = {k: pa.concat_arrays([c, pa.array([v], c.type)]) for (k, c), v in zip(columns.items(), whole)}
        return pa.table(columns)

    return requests.groupBy("bucket").applyInArrow(answer, _ANSWERS)


def scored(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    strength: float = STRENGTH,
    block_bytes: int = BLOCK_BYTES,
    bucket_requests: int = BUCKET_REQUESTS,
    order: int = 2,
) -> DataFrame:
    """One row per row of `docs`: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from rows whose crc32 of the key as text is not 1 modulo 5. Null text counts as empty and
    has the end token only. Without rows to learn from every count is 0. Repeated rows are learned from
    and scored each for itself. An empty table gives no rows. `order` is 2 for pairs of words, or 3 for triples too.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    blocks = store(_blocks(docs, key, text, block_bytes).withColumn("block", F.monotonically_increasing_id()), "text_blocks")
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-tokens // bucket_requests))
    words = store(_answers(_requests(blocks, buckets, False), False), "word_answers")
    pairs = store(_answers(_requests(blocks, buckets, True), True), "pair_answers")
    release_shuffles(docs.sparkSession)
    whole = words.filter("block = -1").agg(F.sum("learned"), F.sum("different")).first()
    total, different = whole[0] or 0, whole[1] or 0
    own = blocks.schema["keys"].dataType.elementType.simpleString()

    texts = blocks.select("block", F.lit(0).alias("part"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("totals"), "keys", "lengths", "trained", "ids", "words")
    nothing = [F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("keys", "lengths", "trained", "ids", "words")]
    answered = lambda i, a: a.filter("block >= 0").select("block", F.lit(i).alias("part"), "bucket", "totals", *nothing)

    def totals_of(table: pa.Table, part: int, hashes: np.ndarray) -> np.ndarray:
        order, _ = dealt(hashes, buckets)
        mine = table.filter(pa.compute.equal(table.column("part"), part)).sort_by("bucket")
        totals = np.zeros(len(hashes), np.int64)
        if len(order):
            totals[order] = np.concatenate([from_planes(x, np.int64) for x in mine.column("totals").to_pylist()])
        return totals

    def ask_triples(table: pa.Table) -> pa.Table:
        row = table.filter(pa.compute.equal(table.column("part"), 0)).slice(0, 1)
        data = row.select(["block", "lengths", "trained", "ids", "words"]).to_pylist()[0]
        block = Block.read(data["lengths"], data["trained"], data["ids"], data["words"])
        codes, _, pair_at = block.pairs()
        found = totals_of(table, 2, block.pair_hashes(codes))
        triples, counts, _, last = block.triples(pair_at)
        asked = block.asked(found >> 1, found % 2 == 1, triples, last)
        hashes = block.triple_hashes(codes, triples[asked])
        return pa.Table.from_batches([_packed(data["block"], None, hashes, counts[asked], buckets)])

    def score(table: pa.Table) -> pa.Table:
        row = table.filter(pa.compute.equal(table.column("part"), 0)).select(["keys", "lengths", "trained", "ids", "words"])
        data = row.slice(0, 1).to_pylist()[0]
        block = Block.read(data["lengths"], data["trained"], data["ids"], data["words"])
        counts = totals_of(table, 1, block.hashes())
        codes, _, pair_at = block.pairs()
        found = totals_of(table, 2, block.pair_hashes(codes))
        pair_counts, third, triple_at = found >> 1, (), np.full(len(pair_at), -1)
        if order == 3:
            triples, triple_counts, triple_at, last = block.triples(pair_at)
            asked = block.asked(pair_counts, found % 2 == 1, triples, last)
            triple_counts[asked] = totals_of(table, 3, block.triple_hashes(codes, triples[asked])) >> 1
            third = triples, triple_counts, last
        made = automaton(counts, total, different, codes, pair_counts, strength, *third)
        ends = np.cumsum(block.lengths)
        starts = ends - block.lengths
        base = np.log10((counts + 0.5) / (total + 0.5 * (different + 1)))[block.ids]
        known = (counts > 0)[block.ids].astype(np.int64)
        ids, n = block.ids, len(starts)
        walked = [made.walk(ids[a:b], pair_at[a:b], triple_at[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        return pa.table(
            {
                key: pa.array(data["keys"], row.schema.field("keys").type.value_type),
                "held_out": pa.array(~block.trained),
                "n_tokens": pa.array(block.lengths),
                "n_known": pa.array(np.add.reduceat(known, starts)),
                "train_tokens": pa.array(np.full(n, total, np.int64)),
                "base_score": pa.array([math.fsum(base[a:b].tolist()) for a, b in zip(starts, ends)], pa.float64()),
                "score": pa.array(walked, pa.float64()),
            }
        )

    layout = (
        f"`{key}` {own}, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
    )
    gathered = texts.unionByName(answered(1, words)).unionByName(answered(2, pairs))
    if order == 3:
        requests = texts.unionByName(answered(2, pairs)).groupBy("block").applyInArrow(ask_triples, _PARTS)
        gathered = gathered.unionByName(answered(3, store(_answers(requests, True), "triple_answers")))
        del requests
        release_shuffles(docs.sparkSession)
    return gathered.groupBy("block").applyInArrow(score, layout)
