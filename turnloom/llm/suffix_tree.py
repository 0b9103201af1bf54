"""Language-model scores from a probabilistic suffix tree over words.

A state is a context of up to ``max_depth`` preceding words of the same text; the root is the
empty one (names in code are fields of ``Settings``). The root gives a token (c + 1) / (N + V + 1).
Every context that occurs twice in the training texts is a candidate, in a table of any size: one
that occurs once has no other occurrence to be predicted from, gains exactly nothing, and could
not be retained. (``min_count`` and ``min_share``, a share of the training tokens, can ask for
more; they are off.) A candidate is retained if its own distribution
tells more than that of its longest retained proper suffix: each training occurrence is
predicted from the others (count less one, smoothed by the suffix state), and the mean gain
must be ``gain`` nats or more. A retained state s predicts
(count(s, w) + a P(w | suffix state)) / (count(s) + a), which sums to one over all words, and a
token is scored by the longest retained suffix of what precedes it.

The tree grows level by level, and no table of words or contexts is ever held by one task:

1. Texts are cut into slices of about ``slice_bytes`` bytes, stored once as numbered distinct words,
   bucketed by slice; later passes read them without a shuffle.
2. A slice asks buckets (of hashes) for the counts of its distinct words; then, level by level,
   for the counts of its distinct pairs of candidate context and next word. It sends each
   pair once, with its own training count, so a hot pair costs an entry a slice.
3. A bucket adds up, judges its contexts, and answers in the order of the question. Contexts
   with at least ``hot`` of all tokens (at most 1 / hot of them exist) are spread over buckets by
   their next words; their sums are added up apart, and the retained ones are broadcast.

Contexts are compared by 64-bit hashes, the next words of one context by 32 bits; the
suffix state's probability is sent to the test as a half-precision logarithm.

Defined results: a null or empty text is its end token alone; a null doc_id counts as an empty
one for the choice of training rows and comes out as null; repeated rows are documents of
their own and score alike; without training rows every token has probability 1; an empty table gives no
rows; a text longer than a slice is a slice of its own and is scored whole; other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from turnloom.llm.common import bucketed, ship, stored, table
from turnloom.llm.words import hash_words, mixed, slices

BUCKET = 2_000_000  # tokens of text for each bucket
MODULUS, HELD = 7, 2
END = np.uint64(0x5BF03635F0A31E21)
STEP = np.uint64(0x9E3779B97F4A7C15)
WORD_BITS = 28

ASKED = "bucket int, slice long, ctx binary, sizes binary, hot binary, next binary, par binary, cnt binary"
ANSWER = "slice long, level int, bucket int, cnt binary, keep binary, n long, ctx binary, sums binary"


@dataclass(frozen=True)
class Settings:
    """What the tree is grown by; sent to the tasks with each pass."""

    max_depth: int = 3
    min_count: int = 2
    min_share: float = 0.0
    a: float = 30.0
    gain: float = 0.5
    hot: float = 1e-6
    hot_count: int = 100_000  # at least
    slice_bytes: int = 8_000_000


def packed(values: np.ndarray) -> bytes:
    """Counts, most of them small: a byte each, the large ones after them."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    values = np.frombuffer(data, np.uint8, n).astype(np.int64)
    values[values == 255] = np.frombuffer(data, "<i8", -1, n)
    return values


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % MODULUS == HELD


def _cut(id_type: pa.DataType, slice_bytes: int):
    """Slices of texts: their rows, words as places among the distinct ones, and their hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def joined() -> pa.RecordBatch:
            hashes, ids = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            # Words of a piece are distinct already: ids leads from pieces to the slice.
            low = np.cumsum([0, *(len(p[0]) for p in parts)])
            tokens = np.concatenate([ids[n : n + len(p[0])][p[1]] for n, p in zip(low, parts)])
            kind = np.uint16 if len(hashes) <= 1 << 16 else np.uint32
            rows = [x for p in parts for x in p[3].to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + made], pa.int64()),
                    pa.array([rows], pa.list_(id_type)),
                    pa.array([np.concatenate([p[4] for p in parts]).tobytes()], pa.binary()),
                    pa.array([np.concatenate([p[2] for p in parts]).tobytes()], pa.binary()),
                    pa.array([tokens.astype(kind).tobytes()], pa.binary()),
                    pa.array([hashes.tobytes()], pa.binary()),
                ],
                ["slice", "doc_ids", "held", "sizes", "tokens", "hashes"],
            )

        for batch in batches:
            for part in slices(batch):
                text = part.column("text")
                words = hash_words(text, lower=True)
                every = np.insert(words.hashes, words.at[1:], END)
                hashes, ids = np.unique(every, return_inverse=True)
                held = part.column("_held").to_numpy(zero_copy_only=False).astype(np.uint8)
                sizes = (np.diff(words.at) + 1).astype(np.int32)
                parts.append((hashes, ids.astype(np.int32), sizes, part.column("doc_id"), held))
                size += len(words.data)
                if size >= slice_bytes:
                    yield joined()
                    made, parts, size = made + 1, [], 0
        if parts:
            yield joined()

    return cut


@dataclass
class Totals:
    """What all slices share: training tokens and distinct ones, buckets, retained hot contexts."""

    tokens: int
    words: int
    buckets: int
    hot: list[np.ndarray]
    by: Settings

    @property
    def least(self) -> float:
        return max(self.by.min_count, self.by.min_share * self.tokens)

    @property
    def hot_least(self) -> float:
        return max(self.by.hot_count, self.by.hot * self.tokens)


class Slice:
    """One slice, brought by the answers so far to the question of the next level."""

    def __init__(self, row: pa.Table):
        get = lambda c, kind: np.frombuffer(row.column(c)[0].as_py(), kind)
        self.id = row.column("slice")[0].as_py()
        self.doc_ids = row.column("doc_ids").combine_chunks().flatten()
        self.held = get("held", np.uint8).astype(bool)
        self.sizes = get("sizes", np.int32).astype(np.int64)
        self.hashes = get("hashes", np.uint64)
        kind = np.uint16 if len(self.hashes) <= 1 << 16 else np.uint32
        self.ids = get("tokens", kind).astype(np.int64)
        self.trains = np.repeat(~self.held, self.sizes)
        self.depth = np.zeros(len(self.ids), dtype=np.int8)
        self.first = np.zeros(len(self.ids), dtype=bool)  # tokens that begin a text
        self.first[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = True

    def order_words(self, buckets: int) -> None:
        self.word_bucket = ((self.hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(self.word_bucket, kind="stable")

    def words_asked(self) -> Iterator[tuple]:
        own = np.bincount(self.ids[self.trains], minlength=len(self.hashes))
        for b, part in _runs(self.word_bucket[self.order]):
            at = self.order[part]
            yield (b, self.id, self.hashes[at].tobytes(), None, None, None, None, packed(own[at]))

    def take_words(self, answers: dict, totals: Totals) -> None:
        """Counts of the words; every context of one word that is frequent enough is asked next."""
        counts = np.zeros(len(self.hashes), dtype=np.int64)
        counts[self.order] = self._counts(answers, 0)
        self.n_word = counts
        self.p = ((counts + 1) / (totals.tokens + totals.words + 1))[self.ids]
        self.base = np.log10(self.p)
        self.ctx_hash, self.ctx_n = mixed(self.hashes), counts
        before = np.append(-1, self.ids[:-1])
        self.ctx = np.where(self.first, -1, before)

    @staticmethod
    def _counts(answers: dict, level: int) -> np.ndarray:
        found = [answers[level][b][0] for b in sorted(answers.get(level, ()))]
        return np.concatenate([np.zeros(0, np.int64), *found])

    def ask(self, totals: Totals) -> None:
        """The distinct pairs of candidate contexts and next words, in order of buckets."""
        n, hashes = self.ctx_n, self.ctx_hash
        salts = np.where(n >= totals.hot_least, np.ceil(n / totals.hot_least), 1).astype(np.int64)
        salts[n < totals.least] = 0
        self.at = np.flatnonzero((self.ctx >= 0) & (np.append(n, 0)[self.ctx] >= totals.least))
        ctx, word = self.ctx[self.at], self.ids[self.at]
        low = np.cumsum(salts) - salts
        of = np.repeat(np.arange(len(n)), salts)
        nth = np.arange(len(of)) - low[of]
        spread = mixed(hashes[of] + nth.astype(np.uint64) * STEP)
        bucket = ((spread >> np.uint64(32)) % np.uint64(totals.buckets)).astype(np.int64)
        order = np.lexsort((spread, bucket))
        rank = np.empty(len(of), dtype=np.int64)
        rank[order] = np.arange(len(of))
        short = self.hashes.astype(np.uint32)
        salt = short[word].astype(np.int64) % np.maximum(salts[ctx], 1)
        key = (rank[low[ctx] + salt] << WORD_BITS) | word
        pairs, one, self.pair = np.unique(key, return_index=True, return_inverse=True)
        block = order[pairs >> WORD_BITS]
        self.pair_ctx, self.pair_word, self.pair_bucket = of[block], pairs & ((1 << WORD_BITS) - 1), bucket[block]
        self.pair_hot = salts[self.pair_ctx] > 1
        self.pair_block = np.cumsum(np.append(True, block[1:] != block[:-1])) - 1 if len(block) else block
        self.pair_par = self.p[self.at[one]]
        self.pair_own = np.bincount(self.pair[self.trains[self.at]], minlength=len(pairs))

    def asked(self) -> Iterator[tuple]:
        short = self.hashes.astype(np.uint32)
        for b, part in _runs(self.pair_bucket):
            blocks = self.pair_block[part]
            begin = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) + part.start
            sizes = np.diff(np.append(begin, part.stop)).astype(np.uint32)
            yield (
                b,
                self.id,
                self.ctx_hash[self.pair_ctx[begin]].tobytes(),
                sizes.tobytes(),
                self.pair_hot[begin].astype(np.uint8).tobytes(),
                short[self.pair_word[part]].tobytes(),
                (-np.log2(self.pair_par[part])).astype(np.float16).tobytes(),
                packed(self.pair_own[part]),
            )

    def take(self, level: int, answers: dict, totals: Totals) -> None:
        """Probabilities by the states of this level, and the contexts of the next."""
        counts = self._counts(answers, level)
        keep = [answers[level][b][1] for b in sorted(answers.get(level, ()))]
        kept = np.concatenate([np.zeros(0, bool), *keep])
        kept = kept[self.pair_block] if len(kept) else np.zeros(0, bool)
        hashes = self.ctx_hash[self.pair_ctx]
        hot = np.append(totals.hot[level - 1], np.uint64(0))
        at = np.searchsorted(hot[:-1], hashes)
        kept = np.where(self.pair_hot, hot[at] == hashes, kept)
        better = (counts + totals.by.a * self.pair_par) / (self.ctx_n[self.pair_ctx] + totals.by.a)
        use = kept[self.pair]
        self.p[self.at[use]] = better[self.pair[use]]
        self.depth[self.at[use]] = level
        # The pairs asked for are the contexts of the tokens that follow.
        following = np.full(len(self.ids) + 1, -1, dtype=np.int64)
        following[self.at + 1] = self.pair
        following = following[:-1]
        following[self.first] = -1
        self.ctx, self.ctx_n = following, counts
        self.ctx_hash = mixed(hashes * STEP + self.hashes[self.pair_word])

    def scores(self, totals: Totals) -> pa.Table:
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        total = lambda x: np.bincount(row, x, len(self.sizes))
        known = total(self.n_word[self.ids] > 0).astype(np.int64)
        return pa.table(
            {
                "doc_id": self.doc_ids,
                "held_out": pa.array(self.held),
                "n_tokens": pa.array(self.sizes),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(known), totals.tokens, dtype=np.int64)),
                "base_score": pa.array(total(self.base)),
                "score": pa.array(total(np.log10(self.p))),
                "context_words": pa.array(total(self.depth).astype(np.int64)),
            }
        )


def _runs(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of a sorted array and where it stands."""
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else []
    for a, b in zip(at, [*at[1:], len(values)]):
        yield int(values[a]), slice(int(a), int(b))


def _found(answers: pa.Table) -> dict:
    """By level and bucket: the counts, and which blocks of contexts are retained."""
    found: dict = {}
    for at, b, cnt, keep, n in zip(*(answers.column(c).to_pylist() for c in ("level", "bucket", "cnt", "keep", "n"))):
        bits = None
        if keep is not None:
            blocks = int.from_bytes(keep[:4], "little")
            bits = np.unpackbits(np.frombuffer(keep, np.uint8, -1, 4))[:blocks].astype(bool)
        found.setdefault(at, {})[b] = (unpacked(cnt, n), bits)
    return found


def _advanced(row: pa.Table, found: dict, level: int, totals: Totals) -> Slice:
    """A slice that has taken the answers below ``level`` and is about to ask for it."""
    one = Slice(row)
    one.order_words(totals.buckets)
    for at in range(level):
        if at == 0:
            one.take_words(found, totals)
        else:
            one.take(at, found, totals)
        one.ask(totals)
    return one


def count_words(rows: pa.Table) -> pa.Table:
    """One bucket of words: the training count of each, to every slice that asked."""
    hashes = [np.frombuffer(x, np.uint64) for x in rows.column("ctx").to_pylist()]
    sizes = [len(h) for h in hashes]
    own = np.concatenate([unpacked(x, n) for x, n in zip(rows.column("cnt").to_pylist(), sizes)])
    _, of = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.bincount(of, own).astype(np.int64)
    ends = np.cumsum(sizes)
    out = [packed(counts[of[e - n : e]]) for e, n in zip(ends, sizes)]
    sums = [np.array([counts.sum(), (counts > 0).sum()], dtype=np.int64).tobytes()]
    return _answers(rows, 0, out, None, sizes, None, sums)


def _answers(rows, level, counts, keep, sizes, hot, sums) -> pa.Table:
    """Answers to each slice, and one row (slice -1) of what the bucket tells the driver."""
    bucket, n = rows.column("bucket")[0].as_py(), len(counts)
    return pa.table(
        {
            "slice": pa.array([*rows.column("slice").to_pylist(), -1], pa.int64()),
            "level": pa.array([level] * (n + 1), pa.int32()),
            "bucket": pa.array([bucket] * (n + 1), pa.int32()),
            "cnt": pa.array([*counts, None], pa.binary()),
            "keep": pa.array([*(keep or [None] * n), None], pa.binary()),
            "n": pa.array([*sizes, None], pa.int64()),
            "ctx": pa.array([None] * n + [hot], pa.binary()),
            "sums": pa.array([None] * n + sums, pa.binary()),
        }
    )


def judge_contexts(level: int, by: Settings):
    """One bucket of a level: adds up pairs, tests contexts, answers every slice."""

    def judge(rows: pa.Table) -> pa.Table:
        get = lambda c, kind: [np.frombuffer(x, kind) for x in rows.column(c).to_pylist()]
        ctx, sizes, hot = get("ctx", np.uint64), get("sizes", np.uint32), get("hot", np.uint8)
        pairs = [int(s.sum()) for s in sizes]
        blocks = [len(s) for s in sizes]
        own = np.concatenate([unpacked(x, n) for x, n in zip(rows.column("cnt").to_pylist(), pairs)])
        every, of_block = np.unique(np.concatenate(ctx), return_inverse=True)
        of = np.repeat(of_block, np.concatenate(sizes))
        following = np.concatenate(get("next", np.uint32)).astype(np.uint64)
        _, one, pair = np.unique(
            (of.astype(np.uint64) << np.uint64(32)) | following, return_index=True, return_inverse=True
        )
        counts = np.bincount(pair, own).astype(np.int64)
        log_p = -np.log(2.0) * np.concatenate(get("par", np.float16))[one].astype(np.float64)
        seen = np.flatnonzero(counts)
        c = counts[seen]
        told = c * (np.log(c - 1 + by.a * np.exp(log_p[seen])) - log_p[seen])
        n = np.bincount(of[one[seen]], c, len(every))
        told = np.bincount(of[one[seen]], told, len(every))
        kept = gains(told, n, by.a) >= by.gain * n
        is_hot = np.bincount(of_block, np.concatenate(hot), len(every)) > 0
        pair_ends, block_ends = np.cumsum(pairs), np.cumsum(blocks)
        out, keep = [], []
        for e, k, be, bk in zip(pair_ends, pairs, block_ends, blocks):
            out.append(packed(counts[pair[e - k : e]]))
            bits = np.packbits(kept[of_block[be - bk : be]])
            keep.append(int(bk).to_bytes(4, "little") + bits.tobytes())
        sums = np.stack([n[is_hot], told[is_hot]]).tobytes()
        return _answers(rows, level, out, keep, pairs, every[is_hot].tobytes(), [sums])

    return judge


def gains(told: np.ndarray, n: np.ndarray, a: float) -> np.ndarray:
    """Log likelihood, in nats, that a state of ``n`` occurrences gains when each is
    predicted from the others."""
    return told - n * np.log(np.maximum(n - 1 + a, 1e-300))


def _hot_kept(answers: DataFrame, by: Settings) -> np.ndarray:
    """The retained hot contexts, sorted; at most 1 / hot exist."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ctx, sums in zip(batch.column("ctx").to_pylist(), batch.column("sums").to_pylist()):
                hashes = np.frombuffer(ctx, np.int64)
                n, told = np.frombuffer(sums, np.float64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n), pa.array(told)], ["c", "n", "told"])

    rows = answers.filter("slice = -1").select("ctx", "sums").mapInArrow(parts, "c long, n double, told double")
    added = rows.groupBy("c").agg(F.sum("n").alias("n"), F.sum("told").alias("told")).toArrow()
    n, told = added.column("n").to_numpy(), added.column("told").to_numpy()
    kept = added.column("c").to_numpy().view(np.uint64)[gains(told, n, by.a) >= by.gain * n]
    return np.sort(kept)


def score_documents(
    docs: DataFrame, held: Column | None = None, by: Settings = Settings()
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and context_words
    (summed lengths of the states used) of each row of ``docs`` (doc_id, text).

    The tree is learnt from the rows for which ``held`` (default: crc32(doc_id) mod 7 is 2) is
    false.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        "doc_id", "text", F.coalesce(held_out() if held is None else held, F.lit(False)).alias("_held")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("slice", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            *[T.StructField(c, T.BinaryType()) for c in ("held", "sizes", "tokens", "hashes")],
        ]
    )
    arrow_id = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    cut = bucketed(rows.mapInArrow(_cut(arrow_id, by.slice_bytes), schema), "slice", max(12, size // (2 * by.slice_bytes)))
    totals = Totals(0, 0, max(12, size // 6 // BUCKET), [], by)

    answers = spark.createDataFrame([], ANSWER)
    asked = _with_answers(cut, answers, _asking(0, totals), ASKED)
    answers = stored(asked.groupBy("bucket").applyInArrow(count_words, ANSWER), "words")
    told = answers.filter("slice = -1").select("sums").toArrow().column("sums").to_pylist()
    known = np.array([np.frombuffer(x, np.int64) for x in told], dtype=np.int64).reshape(-1, 2).sum(axis=0)
    totals = Totals(int(known[0]), int(known[1]), totals.buckets, [], by)
    for level in range(1, by.max_depth + 1):
        asked = _with_answers(cut, answers, _asking(level, totals), ASKED)
        found = stored(asked.groupBy("bucket").applyInArrow(judge_contexts(level, by), ANSWER), "contexts")
        totals = Totals(totals.tokens, totals.words, totals.buckets, [*totals.hot, _hot_kept(found, by)], by)
        answers = answers.unionByName(found)
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")],
            T.StructField("context_words", T.LongType()),
        ]
    )
    return _with_answers(cut, answers, _scoring(totals), out)


def _question(rows: Iterator[tuple]) -> pa.RecordBatch:
    rows = list(rows)
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
    names = ["bucket", "slice", "ctx", "sizes", "hot", "next", "par", "cnt"]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names
    )


def _asking(level: int, totals: Totals):
    def ask(row: pa.Table, answers: pa.Table) -> pa.Table:
        one = _advanced(row, _found(answers), level, totals)
        return pa.Table.from_batches([_question(one.asked() if level else one.words_asked())])

    return ask


def _scoring(totals: Totals):
    def score(row: pa.Table, answers: pa.Table) -> pa.Table:
        found = _found(answers)
        one = _advanced(row, found, totals.by.max_depth, totals)
        if totals.by.max_depth:
            one.take(totals.by.max_depth, found, totals)
        else:
            one.take_words(found, totals)
        return one.scores(totals)

    return score


def _with_answers(cut: DataFrame, answers: DataFrame, use, schema) -> DataFrame:
    """``use`` of each slice and the answers to it; only the answers are shuffled."""
    replies = answers.filter("slice >= 0").select("slice", "level", "bucket", "cnt", "keep", "n")
    return cut.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(use, schema)


def op12_suffix_tree(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))
