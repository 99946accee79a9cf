"""Language-model scoring with a weighted backoff automaton.

Unigrams are smoothed additively and cover every word of the training texts.  Every bigram and trigram that occurs
at least ``least`` times in them (twice) is kept, at any size, and discounted; what is not kept takes the failure arc to
the next shorter context, at the weight (in single precision) that keeps every context's probabilities adding up to 1.

The texts are cut into blocks of about 2 MB, whose words are numbered once.  Nothing of the model is broadcast and no
table of single n-grams is shuffled: a block asks buckets of hash space, in five rounds, for what its own texts can meet
- how often its words occur; its bigrams, of words that occur often enough; its words' failure weights; its trigrams, of
bigrams that are kept; its bigrams' failure weights - and gets the answers in the order in which it asked (see
``shared.answered``).  An n-gram has an owner, the first block that has it, which hands its probability to the sums
behind its context's failure weight.  From the answers a block builds the part of the automaton that its texts can
reach, which gives them the same scores as the whole, and walks it from left to right.  Blocks are bucketed by their
number once, as are their answers, so they meet without moving.

Counts come from all training rows.  A null or empty text is the end token alone.  A null id counts as a training row.
Repeated rows count and are scored each on their own.  Without training rows every token is unknown.  An empty table
gives an empty result.  Other columns are not carried.  Tokens and n-grams are told apart by 64-bit hashes.  A text
longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from curatio.llm.shared import ASK, U64, answered, answers, asks, bytes_hash, chunks, coded, crc32_of_id, dealt, decoded, lists, words

END = U64(1)  # the end of a text, and what stands before its first word
ADD = 0.1
DISCOUNT = 0.5
#: Bytes of text in a block, and tokens of the input for each bucket.
BLOCK, BUCKET = 2 << 20, 2 << 20
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts, each followed by END, and where each text begins."""
    data = _LOWER[data]
    starts, ends, bounds = words(data, offsets)
    return np.insert(bytes_hash(data, starts, ends), bounds[1:], END), bounds + np.arange(len(bounds))


def paired(x: np.ndarray, y: np.ndarray, turn: int) -> np.ndarray:
    """One 64-bit key for two, y's bits turned."""
    return x ^ ((y << U64(turn)) | (y >> U64(64 - turn)))


@dataclass
class Automaton:
    """States with arcs and failure arcs, over words numbered from 0; state 0 has no context.

    state_of[word] is the state of that word as a context, 0 if it has none; begin is the state before a text."""

    unigram: np.ndarray
    state_of: np.ndarray
    keys: np.ndarray  # state << 32 | word, in order
    weight: np.ndarray
    follow: np.ndarray
    failure: np.ndarray
    backoff: np.ndarray
    begin: int

    def step(self, state: np.ndarray, word: np.ndarray, total: np.ndarray) -> np.ndarray:
        """One token in every text: adds its log-probability to total and returns the next states."""
        after, state = np.zeros(len(state), np.int64), state.copy()
        open_ = np.flatnonzero(state > 0)
        root = np.ones(len(state), bool)
        while len(open_):
            key = (state[open_] << 32) | word[open_]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            found, arc = open_[hit], at[hit]
            total[found] += self.weight[arc]
            after[found] = self.follow[arc]
            root[found] = False
            miss = open_[~hit]
            total[miss] += self.backoff[state[miss]]
            state[miss] = self.failure[state[miss]]
            open_ = miss[state[miss] > 0]
        left = np.flatnonzero(root)
        total[left] += self.unigram[word[left]]
        after[left] = self.state_of[word[left]]
        return after

    def scores(self, ids: np.ndarray, bounds: np.ndarray, line: int = 256) -> np.ndarray:
        """Log-probability of each text.  A text is walked in lines of ``line`` tokens, all lines side by side; a line's
        first state is that after the two tokens before it."""
        sizes = np.diff(bounds)
        n_lines = -(-sizes // line)
        doc = np.repeat(np.arange(len(sizes)), n_lines)
        at = (np.arange(len(doc)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)) * line
        first = bounds[:-1][doc] + at
        length = np.minimum(line, sizes[doc] - at)
        order = np.argsort(-length, kind="stable")
        doc, at, first, length = doc[order], at[order], first[order], length[order]
        state = np.where(at == 0, self.begin, 0)
        inner = np.flatnonzero(at > 0)
        for back in (2, 1):  # a line begins two tokens into a text or later
            state[inner] = self.step(state[inner], ids[first[inner] - back], np.zeros(len(inner)))
        total = np.zeros(len(doc))
        active = np.searchsorted(-length, -np.arange(1, line + 1), "right")
        for t in range(line):
            m = active[t]
            if not m:
                break
            part = total[:m]
            state[:m] = self.step(state[:m], ids[first[:m] + t], part)
        return np.bincount(doc, total, len(sizes)).astype(float)


def assembled(unigram: np.ndarray, back1: np.ndarray, end: int, two: tuple[np.ndarray, ...], three: tuple[np.ndarray, ...]) -> Automaton:
    """The automaton of kept n-grams.  back1: words' failure weights, nan for a word that is no context; two: the bigrams'
    words a and b, their probabilities, and failure weights (nan for none); three: the trigrams' bigrams x and y, and
    probabilities."""
    (a, b, p2, back2), (x, y, p3) = two, three
    state_of, pair_state = np.zeros(len(back1), np.int64), np.zeros(len(a), np.int64)
    ones, twos = np.flatnonzero(~np.isnan(back1)), np.flatnonzero(~np.isnan(back2))
    state_of[ones] = np.arange(1, 1 + len(ones))
    pair_state[twos] = np.arange(1 + len(ones), 1 + len(ones) + len(twos))
    failure = np.concatenate([np.zeros(1 + len(ones), np.int64), state_of[b[twos]]])
    backoff = np.concatenate([[0.0], back1[ones], back2[twos]])
    follow = np.where(pair_state > 0, pair_state, state_of[b])
    keys = np.concatenate([(state_of[a] << 32) | b, (pair_state[x] << 32) | b[y]])
    order = np.argsort(keys)
    return Automaton(unigram, state_of, keys[order], np.log10(np.concatenate([p2, p3]))[order], np.concatenate([follow, follow[y]])[order], failure, backoff, int(state_of[end]))


class Texts:
    """A block's texts by numbers, and what its answers say of their words and n-grams, as far as there are answers."""

    def __init__(self, row: dict, n: int, v: int, least: int, trigrams: bool = True) -> None:
        self.hashes, self.times = np.cumsum(decoded(row["hashes"]), dtype=U64), decoded(row["times"]).astype(np.int64)
        self.end = int(np.searchsorted(self.hashes, END))
        told = {k: answers(row.get(k)) for k in ("words", "pairs", "back1", "threes", "back2")}
        self.count = (told["words"] >> U64(1)).astype(np.int64)
        self.low = (self.count + ADD) / (n + ADD * (v + 1))
        if "ids" not in row:
            return
        self.ids, self.sizes = decoded(row["ids"]).astype(np.int64), decoded(row["sizes"]).astype(np.int64)
        self.bounds = np.append(0, np.cumsum(self.sizes))
        training = np.repeat(np.array(row["training"], bool), self.sizes)
        before = np.append(0, self.ids[:-1])
        first = self.bounds[:-1]
        before[first] = self.end
        # bigrams of words that occur often enough
        some = (self.count[before] >= least) & (self.count[self.ids] >= least)
        at = np.flatnonzero(some)
        two, of = np.unique(before[at] * len(self.hashes) + self.ids[at], return_inverse=True)
        self.a, self.b = two // len(self.hashes), two % len(self.hashes)
        self.key2 = paired(self.hashes[self.a], self.hashes[self.b], 21)
        self.times2 = np.bincount(of, training[at], len(two)).astype(np.int64)
        self.order2 = np.argsort(self.key2)
        if row.get("pairs") is None:
            return
        answer = np.zeros(len(two), U64)
        answer[self.order2] = told["pairs"]
        count2 = (answer >> U64(1)).astype(np.int64)
        kept = np.flatnonzero(count2)
        place = np.full(len(two) + 1, -1)
        place[kept] = np.arange(len(kept))
        self.a, self.b, self.key2, self.count2, self.own2 = self.a[kept], self.b[kept], self.key2[kept], count2[kept], (answer[kept] & U64(1)).astype(bool)
        self.order2 = np.argsort(self.key2)
        self.p2 = (self.count2 - DISCOUNT) / np.maximum(self.count[self.a], 1)
        pair = np.full(len(self.ids), -1)
        pair[at] = place[of]
        # words whose failure weight may be wanted: before a word that makes no kept bigram with them, or of bigrams owned here
        wanted = np.zeros(len(self.hashes), bool)
        wanted[before[pair < 0]] = wanted[self.a[self.own2]] = True
        self.contexts = np.flatnonzero(wanted & (self.count >= least))
        if not trigrams:
            return
        # trigrams of two kept bigrams
        ahead = np.append(-1, pair[:-1])
        ahead[first] = -1
        at = np.flatnonzero((pair >= 0) & (ahead >= 0))
        three, of = np.unique(ahead[at] * max(1, len(kept)) + pair[at], return_inverse=True)
        self.x, self.y = three // max(1, len(kept)), three % max(1, len(kept))
        self.key3 = paired(self.key2[self.x], self.key2[self.y], 33)
        self.times3 = np.bincount(of, training[at], len(three)).astype(np.int64)
        self.order3 = np.argsort(self.key3)
        if row.get("threes") is None:
            return
        answer = np.zeros(len(three), U64)
        answer[self.order3] = told["threes"]
        kept = np.flatnonzero(answer >> U64(1))
        place = np.full(len(three) + 1, -1)
        place[kept] = np.arange(len(kept))
        third = np.full(len(self.ids), -1)
        third[at] = place[of]
        self.x, self.y, self.own3 = self.x[kept], self.y[kept], (answer[kept] & U64(1)).astype(bool)
        self.p3 = ((answer[kept] >> U64(1)).astype(np.int64) - DISCOUNT) / self.count2[self.x]
        wanted = np.zeros(len(self.key2), bool)
        wanted[ahead[(ahead >= 0) & (third < 0)]] = wanted[self.x[self.own3]] = True
        self.contexts2 = self.order2[wanted[self.order2]]
        if row.get("back2") is None:
            return
        self.back1, self.back2 = np.full(len(self.hashes), np.nan), np.full(len(self.key2), np.nan)
        self.back1[self.a] = self.back2[self.x] = 0.0  # contexts that no text here fails from
        for back, at, name in ((self.back1, self.contexts, "back1"), (self.back2, self.contexts2, "back2")):
            back[at] = told[name].astype(np.uint32).view(np.float32)

    def automaton(self) -> Automaton:
        return assembled(np.log10(self.low), self.back1, self.end, (self.a, self.b, self.p2, self.back2), (self.x, self.y, self.p3))


def counted(least: int) -> Callable:
    """The answer of a bucket: twice the count of all blocks, 0 under least, and 1 more for the key's owner."""

    def answer(at: np.ndarray, first: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.bincount(at, times.view(np.int64)).astype(np.int64)[at]
        kept = total >= max(1, least)
        return np.where(kept, 2 * total + first, 0).astype(U64), kept & first

    return answer


def failing(at: np.ndarray, first: np.ndarray, own: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answer to sums over a context's kept n-grams: its failure weight in single precision, nan for no context."""
    own, low = (np.bincount(at, x.view(np.float64)) for x in (own, low))
    weight = np.log10(np.maximum(1 - own, 1e-12) / np.maximum(1 - low, 1e-12))
    return np.where(own > 0, weight, np.nan).astype(np.float32).view(np.uint32)[at].astype(U64), first & (own > 0)[at]


def scored(docs: DataFrame, training: Column, *, text: str = "text", key: str = "doc_id", least: int = 2, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; training: which rows to learn from.

    least: how often an n-gram must occur to be kept.  block, bucket: bytes of text in a block, tokens of the input for
    a bucket; they change no result."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(training, F.lit(True)).alias("training"))
    kind = docs.schema[key].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for part, data, offsets in chunks(batches, "text", block):
            found, bounds = tokens(data, offsets)
            own, ids = np.unique(found, return_inverse=True)
            told = np.repeat(np.array(part.column("training"), bool), np.diff(bounds))
            times = np.bincount(ids, told, len(own)).astype(U64)
            whole = np.array([0, part.num_rows])
            packed = [coded(x) for x in (np.diff(bounds).astype(U64), np.diff(own, prepend=U64(0)), times, ids.astype(U64))]
            columns = [pa.array([uid]), pa.array([len(ids)]), pa.array([int(told.sum())]), lists(part.column("key"), whole), lists(part.column("training"), whole), *(pa.array([x], pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(columns, names)
            uid += 1

    kinds = {"block": LongType(), "tokens": LongType(), "learnt": LongType(), "keys": ArrayType(kind), "training": ArrayType(BooleanType()), "sizes": BinaryType(), "hashes": BinaryType(), "times": BinaryType(), "ids": BinaryType()}
    names = list(kinds)
    blocks = dealt(rows.mapInArrow(cut, StructType([StructField(c, t) for c, t in kinds.items()])), "blocks", "block")
    total, n = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("learnt"), F.lit(0))).first()
    bits = max(1, (total // bucket).bit_length())
    v = 0

    def asking(of: Callable[[Texts], tuple[np.ndarray, list[np.ndarray]]], trigrams: bool = False) -> Callable:
        """What every block asks: of(texts) gives keys in order, and what is said of each."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    keys, said = of(Texts(row, n, v, least, trigrams))
                    if len(keys):
                        yield asks(row["block"], keys, said, bits)

        return task

    def with_answers(*told: tuple[str, DataFrame]) -> DataFrame:
        table = blocks.select("block", "keys", "training", "sizes", "hashes", "times", "ids")
        for name, answers_ in told:
            # a block without questions of a round has no answers, which is not the same as a round that is still to come
            got = answers_.select("block", F.col("told").alias(name)).hint("merge")
            table = table.join(got, "block", "left").withColumn(name, F.coalesce(name, F.array().cast("array<binary>")))
        return table

    def round_(of: Callable, answer: Callable, name: str, *told: tuple[str, DataFrame], trigrams: bool = False) -> tuple[str, DataFrame]:
        table = with_answers(*told).drop("keys") if told else blocks.select("block", "hashes", "times")
        return name, answered(table.mapInArrow(asking(of, trigrams), ASK), answer, name)

    def sums(groups: np.ndarray, values: tuple[np.ndarray, np.ndarray], own: np.ndarray, size: int, at: np.ndarray) -> list[np.ndarray]:
        """Of the n-grams that a block owns, by context."""
        return [np.bincount(groups[own], x[own], size)[at].astype(np.float64) for x in values]

    words_ = round_(lambda t: (t.hashes, [t.times]), counted(1), "words")
    v = words_[1].agg(F.coalesce(F.sum("news"), F.lit(0))).first()[0]
    pairs = round_(lambda t: (t.key2[t.order2], [t.times2[t.order2]]), counted(least), "pairs", words_)
    back1 = round_(lambda t: (t.hashes[t.contexts], sums(t.a, (t.p2, t.low[t.b]), t.own2, len(t.hashes), t.contexts)), failing, "back1", words_, pairs)
    threes = round_(lambda t: (t.key3[t.order3], [t.times3[t.order3]]), counted(least), "threes", words_, pairs, trigrams=True)
    back2 = round_(lambda t: (t.key2[t.contexts2], sums(t.x, (t.p3, t.p2[t.y]), t.own3, len(t.key2), t.contexts2)), failing, "back2", words_, pairs, threes, trigrams=True)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                t = Texts(one.drop_columns(["keys"]).to_pylist()[0], n, v, least)
                doc = np.repeat(np.arange(len(t.sizes)), t.sizes)
                base = np.bincount(doc, np.log10(t.low)[t.ids], len(t.sizes)).astype(float)
                known = np.bincount(doc, t.count[t.ids] > 0, len(t.sizes)).astype(np.int64)
                columns = [one.column("keys")[0].values, one.column("training")[0].values, pa.array(t.sizes), pa.array(known), pa.array(base), pa.array(t.automaton().scores(t.ids, t.bounds))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "training", "n_tokens", "n_known", "base_score", "score"])

    kinds = {"key": kind, "training": BooleanType(), "n_tokens": LongType(), "n_known": LongType(), "base_score": DoubleType(), "score": DoubleType()}
    done = with_answers(words_, pairs, back1, threes, back2).mapInArrow(score, StructType([StructField(c, t) for c, t in kinds.items()]))
    return done.select(F.col("key").alias(key), (~F.col("training")).alias("held_out"), "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, crc32_of_id(F.col("doc_id")) % 10 != 0)
