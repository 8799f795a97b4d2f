"""Documents scored by the masked pseudo-likelihood of a small bidirectional network.

Words are numbered by their counts over the whole corpus: the commonest have numbers
of their own, all others share the rest by hash. From the words on both sides a
hidden layer predicts the masked word in two steps, the group of its number and its
place in the group. Every task trains on positions of its own documents from common
parameters; their means, weighted by positions, are the next parameters. The rounds
deal out the positions by hash: each is masked and predicted once over all rounds. A
score sums the log-probability of every word of the document, each masked in turn.

A word without a number of its own has the probability of its number times its share
of the number's words, by the counts of the whole corpus, which stay a Spark table met
by a join. Each count is raised by one, and words never seen have a count of one in all.

Texts are cut into words twice: to count them, and to write their numbers, from which
all rounds train and scores are taken. As each task averages into the common
parameters, scores depend a little on how Spark cuts the table of numbers into tasks.

Null and empty texts have 0 words, a sum of 0 and no mean. Rows that repeat are
trained on and scored each. An empty corpus leaves the first parameters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.flat import BLANKS, U64, flatten, mix, row_of, slices, words
from paywatch.session import materialize

GROUPS, PLACES = 64, 64
CODES = GROUPS * PLACES
COMMON = CODES // 2
HIDDEN, REACH = 16, 2
ROUNDS, RATE, BATCH = 2, 0.3, 2048
#: Rows of one matrix product; so few that it runs in the calling thread.
BLOCK = 256
#: Pieces in which parameters travel, and lanes in which they are first averaged.
PIECES, LANES = 16, 64

Parameters = dict[str, np.ndarray]


def first_parameters(seed: int = 11) -> Parameters:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "words": draw(CODES + 1, HIDDEN) * 3,
        "sides": draw(2 * REACH, HIDDEN) + 1,
        "bias": draw(HIDDEN),
        "group": draw(HIDDEN, GROUPS),
        "group_bias": np.zeros(GROUPS, np.float32),
        "given": draw(GROUPS, HIDDEN),
        "place": draw(HIDDEN, PLACES),
        "place_bias": np.zeros(PLACES, np.float32),
        "given_bias": np.zeros((GROUPS, PLACES), np.float32),
    }


def joined(p: Parameters) -> np.ndarray:
    return np.concatenate([v.ravel() for v in p.values()])


def parted(flat: np.ndarray) -> Parameters:
    out, at = {}, 0
    for name, like in first_parameters().items():
        out[name] = flat[at : at + like.size].reshape(like.shape).astype(np.float32)
        at += like.size
    return out


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) % U64(CODES - COMMON)).astype(np.int64)


def codes_of(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Number of each word; `common` holds the hashes of the commonest, sorted."""
    out = COMMON + bucket_of(hashes)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        known = common[at] == hashes
        out[known] = at[known]
    return out


STEPS = np.array([*range(-REACH, 0), *range(1, REACH + 1)])


def spaced(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with REACH times CODES, for no word, around each text, and the place of each word in them."""
    place = np.arange(len(codes)) + REACH * (owner + 1)
    out = np.full(len(codes) + REACH * (int(owner[-1]) + 2 if len(owner) else 1), CODES, np.int64)
    out[place] = codes
    return out, place


def contexts(codes: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers of the words on both sides; CODES stands for no word."""
    numbers, place = spaced(codes, owner)
    return numbers[place[at][:, None] + STEPS]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b by blocks of rows, so small that the matrix library starts no threads beside Spark's."""
    if len(a) <= BLOCK:
        return a @ b
    out = np.empty((len(a), b.shape[1]), a.dtype)
    for k in range(0, len(a), BLOCK):
        np.matmul(a[k : k + BLOCK], b, out=out[k : k + BLOCK])
    return out


def _crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b, likewise."""
    return sum(a[k : k + BLOCK].T @ b[k : k + BLOCK] for k in range(0, len(a), BLOCK))


def _levelled(x: np.ndarray) -> np.ndarray:
    """Logits whose exponentials neither overflow nor vanish together."""
    if len(x) and (x.max() > 60 or x.min() < -60):
        x -= x.max(1, keepdims=True)
    return x


def _softmax(x: np.ndarray) -> np.ndarray:
    np.exp(_levelled(x), out=x)
    x /= np.einsum("nk->n", x)[:, None]
    return x


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows that go to each of n places."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[at[first]] = np.add.reduceat(rows.take(order, 0), first, 0)
    return out


def predict(p: Parameters, near: np.ndarray, target: np.ndarray):
    seen = p["words"].take(near, 0)
    hidden = p["bias"] + seen[:, 0] * p["sides"][0]
    for k in range(1, 2 * REACH):
        hidden += seen[:, k] * p["sides"][k]
    np.tanh(hidden, out=hidden)
    group, place = target // PLACES, target % PLACES
    by_group = _softmax(_times(hidden, p["group"]) + p["group_bias"])
    given = hidden + p["given"].take(group, 0)
    by_place = _softmax(_times(given, p["place"]) + (p["given_bias"] + p["place_bias"]).take(group, 0))
    return seen, hidden, given, group, place, by_group, by_place


def by_side(p: Parameters) -> np.ndarray:
    """What each word adds to the hidden layer from each side."""
    return p["words"] * p["sides"][:, None]


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax at one place of each row."""
    own = _levelled(x)[np.arange(len(at)), at]
    np.exp(x, out=x)
    return own - np.log(np.einsum("nk->n", x))


def log_probability(p: Parameters, near: np.ndarray, target: np.ndarray, sided: np.ndarray | None = None) -> np.ndarray:
    """Of each target between its neighbours; `sided` is by_side(p), where it is at hand."""
    sided = by_side(p) if sided is None else sided
    hidden = p["bias"] + sided[0].take(near[:, 0], 0)
    for k in range(1, 2 * REACH):
        hidden += sided[k].take(near[:, k], 0)
    np.tanh(hidden, out=hidden)
    group, place = target // PLACES, target % PLACES
    out = _log_share(_times(hidden, p["group"]) + p["group_bias"], group)
    hidden += p["given"].take(group, 0)
    bias = p["given_bias"] + p["place_bias"]
    return out + _log_share(_times(hidden, p["place"]) + bias.take(group, 0), place)


def train_step(p: Parameters, near: np.ndarray, target: np.ndarray, rate: float) -> None:
    seen, hidden, given, group, place, by_group, by_place = predict(p, near, target)
    rows, scale = np.arange(len(target)), np.float32(rate / len(target))
    by_group[rows, group] -= 1
    by_place[rows, place] -= 1
    to_given = _times(by_place, p["place"].T)
    to_hidden = (_times(by_group, p["group"].T) + to_given) * (1 - hidden**2)
    to_words = to_hidden[:, None, :] * p["sides"]
    p["sides"] -= scale * np.einsum("nh,nkh->kh", to_hidden, seen)
    p["bias"] -= scale * to_hidden.sum(0)
    p["group"] -= scale * _crossed(hidden, by_group)
    p["group_bias"] -= scale * by_group.sum(0)
    p["place"] -= scale * _crossed(given, by_place)
    p["place_bias"] -= scale * by_place.sum(0)
    # Rows of tables are met by few positions each: they take steps 16 times as long.
    p["given"] -= 16 * scale * _sums(group, to_given, GROUPS)
    p["given_bias"] -= 16 * scale * _sums(group, by_place, GROUPS)
    p["words"] -= 16 * scale * _sums(near.ravel(), to_words.reshape(-1, HIDDEN), CODES + 1)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, bucket and n of every word of all documents, by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(0))
            hashes = [
                words(flat[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], BLANKS)[0] for a, b in slices(bounds)
            ]
            found, n = np.unique(np.concatenate([*hashes, np.zeros(0, U64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(bucket_of(found)), pa.array(n)], names=["word", "bucket", "n"]
            )

    counts = docs.select(text_col).mapInArrow(count, "word long, bucket long, n long")
    return counts.groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def common_and_rare(counts: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """Hashes of the commonest words, sorted, and the counts of all others."""
    top = counts.orderBy(F.desc("n"), "word").limit(COMMON).select("word", "n").toArrow()
    if not top.num_rows:
        return np.zeros(0, U64), counts
    word, n = top["word"][-1].as_py(), top["n"][-1].as_py()
    rare = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    return np.sort(top["word"].to_numpy().view(np.uint64)), rare


def encode(docs: DataFrame, common: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's words as 16-bit numbers, written once: row, doc_id, n_words, seed, codes
    and pairs, the different words outside the commonest with how often the row has them."""
    sent = docs.sparkSession.sparkContext.broadcast(common)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                hashes, counts = words(flat[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], BLANKS)
                codes, owner = codes_of(hashes, sent.value), row_of(counts)
                others = np.flatnonzero(codes >= COMMON)
                ends = np.concatenate([[0], np.cumsum(counts)])
                sums = np.concatenate([[U64(0)], np.cumsum(hashes, dtype=U64)])
                body = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(2 * ends), pa.py_buffer(codes.astype(np.uint16))]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(counts.astype(np.int64)),
                        pa.array(mix(sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)),
                        body.cast(pa.binary()),
                        _pairs(hashes[others], owner[others], len(counts)),
                    ],
                    names=["doc_id", "n_words", "seed", "codes", "pairs"],
                )

    schema = f"doc_id {kind}, n_words long, seed long, codes binary, pairs array<struct<word:long,times:int>>"
    coded = docs.select(id_col, text_col).mapInArrow(run, schema)
    return materialize(coded.withColumn("row", F.monotonically_increasing_id()), "word-numbers")


def _numbers(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch of `n_words` and `codes`, with the numbers and the text of each word."""
    ends = np.concatenate([[0], np.cumsum(batch.column("n_words").to_numpy())])
    for low, high in slices(2 * ends):
        column = batch.column("codes").slice(low, high - low).cast(pa.large_binary())
        codes = np.frombuffer(b"".join(column.to_pylist()), np.uint16).astype(np.int64)
        yield low, high, codes, row_of(np.diff(ends[low : high + 1]))


def _trained(coded: DataFrame, start, turn: int) -> DataFrame:
    """Parameters after a pass over each partition, in pieces with their weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = {k: v.copy() for k, v in start.value.items()}
        seen = 0
        for batch in batches:
            seeds = batch.column("seed").to_numpy().view(np.uint64)
            for low, high, codes, owner in _numbers(batch):
                # By text and place in it alone, so that each place has one turn.
                begins = np.searchsorted(owner, np.arange(high - low))
                chance = mix(seeds[low:high][owner] + (np.arange(len(codes)) - begins[owner]).astype(U64))
                at = np.flatnonzero(chance % U64(ROUNDS) == U64(turn))
                at = at[np.argsort(chance[at])]
                numbers, place = spaced(codes, owner)
                for k in range(0, len(at), BATCH):
                    mine = at[k : k + BATCH]
                    train_step(p, numbers[place[mine][:, None] + STEPS], codes[mine], RATE / (1 + seen / 2e5))
                    seen += len(mine)
        if seen:
            pieces = np.array_split(joined(p), PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PIECES, dtype=np.int32)), pa.array([seen] * PIECES, pa.int64()), pa.array([x.astype(np.float32).tobytes() for x in pieces], pa.binary())],
                names=["piece", "weight", "body"],
            )

    return coded.select("n_words", "seed", "codes").mapInArrow(run, "piece int, weight long, body binary")


def _mean(rows: pa.Table) -> pa.Table:
    weight = rows["weight"].to_numpy()
    total = np.zeros(len(rows["body"][0].as_py()) // 4)
    for w, body in zip(weight, rows["body"], strict=True):
        total += w * np.frombuffer(body.as_buffer(), np.float32)
    return pa.table(
        {"piece": rows["piece"].slice(0, 1), "weight": pa.array([int(weight.sum())]), "body": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())}
    )


def average(trained: DataFrame) -> np.ndarray | None:
    """Weighted mean of all parameters: first in lanes, then the lanes; one set reaches the driver."""
    schema = "piece int, weight long, body binary"
    lanes = trained.withColumn("lane", F.pmod(F.xxhash64("body"), F.lit(LANES)))
    first = lanes.groupBy("piece", "lane").applyInArrow(lambda t: _mean(t), schema)
    rows = first.groupBy("piece").applyInArrow(lambda t: _mean(t), schema).orderBy("piece").collect()
    return np.concatenate([np.frombuffer(r["body"], np.float32) for r in rows]) if rows else None


def counted(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, DataFrame]:
    return common_and_rare(materialize(word_counts(docs, text_col), "word-counts"))


def train_coded(coded: DataFrame) -> Parameters:
    context, p = coded.sparkSession.sparkContext, first_parameters()
    for turn in range(ROUNDS):
        flat = average(_trained(coded, context.broadcast(p), turn))
        p = p if flat is None else parted(flat)
    return p


def train(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, Parameters, DataFrame]:
    """The commonest words, the parameters and the counts of all other words."""
    common, rare = counted(docs, text_col)
    coded = encode(docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")), common)
    return common, train_coded(coded), rare


def unseen_shares(rare: DataFrame) -> np.ndarray:
    """Log of the share that words never seen have of each bucket."""
    logs = np.zeros(CODES - COMMON)
    for row in rare.groupBy("bucket").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        logs[row.bucket] = -np.log(row.n + 1)
    return logs


def _pairs(hashes: np.ndarray, owner: np.ndarray, rows: int) -> pa.ListArray:
    """The different words of each row, with how often it has them."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(first, append=len(order)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(times)], names=["word", "times"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[first], np.arange(rows + 1)), pa.int32()), pairs)


def score(
    docs: DataFrame, common: np.ndarray, p: Parameters, rare: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, log_likelihood and mean_log_likelihood of every row, by a trained model."""
    return score_coded(encode(docs, common, id_col, text_col), p, rare)


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `score`, by a model of the same documents, whose numbers are written once for both."""
    common, rare = counted(docs, text_col)
    coded = encode(docs, common, id_col, text_col)
    return score_coded(coded, train_coded(coded), rare)


def score_coded(coded: DataFrame, p: Parameters, rare: DataFrame) -> DataFrame:
    """Tasks give each word outside the commonest the share of one never seen; the join
    with the counts adds log(n + 1) for those that are known. As none of these words
    is commoner than the last of the commonest, no join key is hot.
    """
    model = coded.sparkSession.sparkContext.broadcast((p, unseen_shares(rare)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, unseen = model.value
        sided = by_side(p)
        for batch in batches:
            totals = [np.zeros(0)]
            for low, high, codes, owner in _numbers(batch):
                numbers, place = spaced(codes, owner)
                logs = np.zeros(len(codes))
                for k in range(0, len(codes), 2 * BATCH):
                    near = numbers[place[k : k + 2 * BATCH, None] + STEPS]
                    logs[k : k + 2 * BATCH] = log_probability(p, near, codes[k : k + 2 * BATCH], sided)
                others = np.flatnonzero(codes >= COMMON)
                logs[others] += unseen[codes[others] - COMMON]
                totals.append(np.bincount(owner, logs, high - low))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "n_words")), pa.array(np.concatenate(totals))],
                names=["row", "doc_id", "n_words", "log_likelihood"],
            )

    kind = coded.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_words long, log_likelihood double"
    scored = coded.select("row", "doc_id", "n_words", "codes").mapInArrow(run, schema)
    known = coded.selectExpr("row", "inline(pairs)").join(rare.select("word", "n"), "word")
    known = known.groupBy("row").agg(F.sum(F.col("times") * F.log(F.col("n") + 1.0)).alias("known"))
    total = F.col("log_likelihood") + F.coalesce("known", F.lit(0.0))
    out = scored.join(known, "row", "left").select("doc_id", "n_words", total.alias("log_likelihood"))
    return out.withColumn("mean_log_likelihood", F.expr("log_likelihood / nullif(n_words, 0)"))
