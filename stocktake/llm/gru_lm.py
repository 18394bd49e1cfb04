"""Document log-likelihood by a gated recurrent language model in numpy, beside a unigram base.

Vocabulary: the ``WORDS - 2`` most common training words, the end of a text, and one id for all other words. The
softmax is factored into classes of equal size, in order of frequency: P(class) times P(word in
class). A word outside the vocabulary has the probability of the shared id times its add-one share
of the other training words. So a text's score is a sum over all of its words and its end.

Training: truncated backpropagation through ``WINDOW`` steps, the state carried on from window to
window. Texts lie one after another in lanes; the state is reset where a text begins. In each of
``ROUNDS`` rounds every task trains on its own part of the round's training texts from the same start, and
the weights are averaged by tokens, in a tree of Spark stages. The rounds' texts are disjoint parts, by a hash of
``doc_id``, that together make all training texts.

Counts cover the whole corpus. The ``TOP_COUNTS`` most common words' counts (16 bytes each) go to
every task; the other words of the texts meet their counts in a join.

Defined cases: a null or empty text is its end alone; a null ``doc_id`` counts as held out; without training
texts N and V are 0 and the model is untrained; rows are scored alike whatever their ``doc_id``. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.text import hashes, most_counted, row_sums, rows_at, scratch, slices, stored, text_rows, words

WORDS, CLASSES, HIDDEN = 2048, 64, 16
MEMBERS = WORDS // CLASSES
END, OTHER = 0, 1
WINDOW, LANES, ROUNDS, RATE = 16, 256, 2, 0.05
TOP_COUNTS = 1 << 18
#: The end of a text among the counted words.
END_HASH = np.uint64(0)
#: Tokens that a task trains on, or scores, in one set of lanes.
SET_TOKENS = 1 << 21
EPS = 1e-8
#: Rows of a class that are multiplied at once.
CHUNK = 16


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def coded_tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A code for each word of every text and its end, row offsets, and the hashes that the codes point to."""
    codes, offsets, known = words(text, lower=True)
    h = hashes(known)
    h[h == END_HASH] = np.uint64(1)
    return np.insert(codes, offsets[1:], len(h)), offsets + np.arange(len(offsets)), np.append(h, END_HASH)


class Counts:
    """The most common words: sorted hashes, counts, and model ids (``OTHER`` beyond the vocabulary); corpus sums."""

    def __init__(self, table: DataFrame) -> None:
        total = table.agg(F.sum("n"), F.count("*")).first()
        self.tokens, self.distinct = int(total[0] or 0), int(total[1] or 0)
        top = most_counted(table, TOP_COUNTS).toPandas().sort_values(["n", "h"], ascending=[False, True])
        h, n = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
        ids = np.full(len(h), OTHER, np.int32)
        own = np.flatnonzero(h != END_HASH)[: WORDS - 2]
        ids[own] = np.arange(2, 2 + len(own))
        ids[h == END_HASH] = END
        order = np.argsort(h)
        self.hash, self.n, self.id = h[order], n[order], ids[order]
        self.known = int(len(own)) + int((h == END_HASH).any())
        self.by_id = np.zeros(WORDS)
        self.by_id[ids[ids != OTHER]] = n[ids != OTHER]
        self.by_id[OTHER] = self.tokens - self.by_id.sum()

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a word is among the top, its count, its model id."""
        if not len(self.hash):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.where(h == END_HASH, END, OTHER).astype(np.int32)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = self.hash[at] == h
        return hit, np.where(hit, self.n[at], 0), np.where(hit, self.id[at], np.where(h == END_HASH, END, OTHER)).astype(np.int32)


def initial(by_id: np.ndarray) -> dict[str, np.ndarray]:
    """Small weights of a fixed draw; the biases give the unigram model of the classes and of the words in them."""
    rng, h = np.random.default_rng(7), HIDDEN
    n = (by_id + 1).reshape(CLASSES, MEMBERS)
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {
        "x": draw(WORDS, 3 * h), "u": draw(h, 3 * h), "wc": draw(h, CLASSES), "bc": np.log(n.sum(1) / n.sum()).astype(np.float32),
        "wo": draw(CLASSES, h, MEMBERS), "bo": np.log(n / n.sum(1, keepdims=True)).astype(np.float32),
    }


class Lanes:
    """Texts (ids, offsets) side by side in lanes, the longest lane first; a window of steps is laid out when it is asked for.

    So a long text takes the room of its own ids, not of as many steps in every lane."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, lanes: int) -> None:
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        lanes = max(1, min(lanes, len(order)))
        load, of = np.zeros(lanes, np.int64), []
        for k in range(0, len(order), lanes):  # each row of texts, longest first, onto the emptiest lanes
            part = order[k : k + lanes]
            to = np.argsort(load, kind="stable")[: len(part)]
            load[to] += size[part]
            of.append(to)
        lane = np.concatenate(of) if of else np.empty(0, np.int64)
        place = np.argsort(-load, kind="stable")
        rank = np.empty(lanes, np.int64)
        rank[place] = np.arange(lanes)
        self.length, lane = load[place], rank[lane] if len(lane) else lane
        # The ids lane by lane, texts in the order in which they came to their lanes.
        place = np.lexsort((np.arange(len(order)), lane))
        order = order[place]
        self.first = np.cumsum(self.length) - self.length
        starts = np.cumsum(size[order]) - size[order]
        total = int(size[order].sum())
        self.ids = np.asarray(ids)[np.repeat(offsets[order] - starts, size[order]) + np.arange(total)].astype(np.int32)
        self.text = np.repeat(order, size[order]).astype(np.int32)
        self.begins = np.zeros(total, bool)
        self.begins[starts] = True

    @property
    def lanes(self) -> int:
        return len(self.length)

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``inputs, targets, begins, text`` (-1: none) by step and lane, for the lanes that are not over."""
        for t in range(0, int(self.length[0]), steps):
            live = int((self.length > t).sum())
            step = np.arange(t, min(t + steps, int(self.length[0])))[:, None]
            there = step < self.length[:live]
            at = np.where(there, self.first[:live] + step, 0)
            begins = self.begins[at] & there
            targets = np.where(there, self.ids[at], 0)
            inputs = np.where(there & ~begins, self.ids[at - 1], 0)
            yield inputs, targets, begins, np.where(there, self.text[at], -1)


def run_window(w: dict, x: np.ndarray, begins: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States after every step of a window, and what its backward pass needs (the states before, gates, candidates, their recurrent parts).

    Inside, and in what the backward pass gets, units come before lanes: so a part of a step's gates is one piece of memory."""
    d, (steps, lanes), kind = HIDDEN, x.shape, np.result_type(w["u"], w["x"], h)
    given, fresh = across(np.take(w["x"], x, axis=0)), begins.any(axis=1)
    before, n, gn, out = (np.empty((steps, d, lanes), kind) for _ in range(4))
    gates, into, turned, h = np.empty((steps, 2 * d, lanes), kind), np.empty((3 * d, lanes), kind), w["u"].T, h.T
    for t in range(steps):
        before[t] = h
        if fresh[t]:
            before[t][:, begins[t]] = 0
        h, g, now = before[t], gates[t], out[t]
        np.matmul(turned, h, out=into)
        np.add(given[t, : 2 * d], into[: 2 * d], out=g)
        g *= 0.5  # the logistic function, by tanh
        np.tanh(g, out=g)
        g *= 0.5
        g += 0.5
        gn[t] = into[2 * d :]
        np.multiply(g[:d], gn[t], out=n[t])
        n[t] += given[t, 2 * d :]
        np.tanh(n[t], out=n[t])
        np.subtract(h, n[t], out=now)
        now *= g[d:]
        now += n[t]
        h = now
    return across(out), (before, gates, n, gn)


def across(x: np.ndarray) -> np.ndarray:
    """The last two axes of every step change places."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


#: Values that lie no further apart than this are all shifted by the largest one before exp (float32 goes down to exp(-87)).
SAFE_RANGE = 60


def shifted_exp(x: np.ndarray) -> np.ndarray:
    """exp in place, less the largest value of all, or of each row where they lie far apart; the sums of the rows."""
    most = x.max(initial=0)
    x -= most if most - x.min(initial=0) < SAFE_RANGE else x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def softmax(x: np.ndarray) -> np.ndarray:
    """Over the last axis (of a power of two), in place."""
    most = x
    while most.shape[-1] > 1:  # by halves: many times faster than along each short row
        half = most.shape[-1] // 2
        most = np.maximum(most[..., :half], most[..., half:])
    x -= most
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def log10_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 of the softmax of each row at one place."""
    total = shifted_exp(x)
    return np.log10(x[np.arange(len(at)), at] / total + 1e-30)


def by_class(y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of the ids by class, and each class that occurs with its first and last place in that order."""
    c = (y // MEMBERS).astype(np.int16)
    ends = np.cumsum(np.bincount(c, minlength=CLASSES)).tolist()
    return np.argsort(c, kind="stable"), [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if b > a]


def member_logits(w: dict, h: np.ndarray, y: np.ndarray, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits of all words of each id's class; the rows come by class."""
    q = np.empty((len(y), MEMBERS), np.result_type(h, w["wo"]))
    for c, a, b in classes:
        np.matmul(h[a:b], w["wo"][c], out=q[a:b])
    q += np.take(w["bo"], y // MEMBERS, axis=0)
    return q


def log10_of(w: dict, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log10 probability of the ids ``y`` after the states ``h``."""
    out = log10_share(h @ w["wc"] + w["bc"], y // MEMBERS)
    order, classes = by_class(y)
    y = y[order]
    out[order] += log10_share(member_logits(w, h[order], y, classes), y % MEMBERS)
    return out


def member_gradients(w: dict, h: np.ndarray, y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the words-in-class weights and biases and of the states, for all classes at once.

    The targets are dealt by class into chunks of ``CHUNK`` rows (the last one of a class is filled up), so
    that one product of stacked small matrices serves all classes."""
    d, c = HIDDEN, y // MEMBERS
    wo, bo, dh = np.zeros_like(w["wo"]), np.zeros_like(w["bo"]), np.zeros_like(h)
    if not len(y):
        return wo, bo, dh
    order, counts = np.argsort(c.astype(np.int16), kind="stable"), np.bincount(c, minlength=CLASSES)
    chunks = -(-counts // CHUNK)
    first = np.cumsum(chunks) - chunks
    place = np.arange(len(y)) + np.repeat(first * CHUNK - (np.cumsum(counts) - counts), counts)
    of = np.repeat(np.arange(CLASSES), chunks)
    states = np.zeros((len(of) * CHUNK, d), h.dtype)
    states[place], y = h[order], y[order]
    states, weights = states.reshape(-1, CHUNK, d), w["wo"][of]
    q = (states @ weights).reshape(-1, MEMBERS)
    p = np.take(q, place, axis=0)
    p += np.take(w["bo"], y // MEMBERS, axis=0)
    p = softmax(p)
    p[np.arange(len(y)), y % MEMBERS] -= 1
    p *= scale
    q[:] = 0  # in the rows that fill up a chunk
    q[place] = p
    q = q.reshape(-1, CHUNK, MEMBERS)
    present = np.flatnonzero(counts)
    wo[present] = sums_from(states.transpose(0, 2, 1) @ q, first[present])
    bo[present] = sums_from(q.sum(axis=1), first[present])
    dh[order] = np.take((q @ weights.transpose(0, 2, 1)).reshape(-1, d), place, axis=0)
    return wo, bo, dh


def sums_from(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the values from each start to the next, as ``np.add.reduceat`` makes them; most runs are short and need no call of it."""
    size = np.diff(np.append(starts, len(values)))
    out = np.take(values, starts, axis=0)
    two, more = np.flatnonzero(size == 2), np.flatnonzero(size > 2)
    out[two] += np.take(values, starts[two] + 1, axis=0)
    if len(more):
        ends = np.cumsum(size[more])
        own = np.arange(ends[-1]) + np.repeat(starts[more] - (ends - size[more]), size[more])
        out[more] = np.add.reduceat(np.take(values, own, axis=0), ends - size[more], axis=0)
    return out


def sums_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` (below ``WORDS``) in ascending order, and the sums of their ``values``."""
    order = np.argsort(rows.astype(np.int16), kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[starts], sums_from(np.take(values, order, axis=0), starts)


def window_gradients(w: dict, x: np.ndarray, y: np.ndarray, begins: np.ndarray, live: np.ndarray, h0: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Mean gradients of -log P over a window (backpropagation is cut at its start), ``x`` only for the rows that come next, and the last state."""
    d, (steps, lanes) = HIDDEN, x.shape
    states, (before, gates, n, gn) = run_window(w, x, begins, h0)
    at = np.flatnonzero(live.ravel())
    h, target = states.reshape(-1, d)[at], y.ravel()[at]
    scale = h.dtype.type(1 / max(len(at), 1))
    p = softmax(h @ w["wc"] + w["bc"])
    p[np.arange(len(at)), target // MEMBERS] -= 1
    p *= scale
    g = {"wc": h.T @ p, "bc": p.sum(0)}
    g["wo"], g["bo"], dh = member_gradients(w, h, target, scale)
    out = np.zeros((steps * lanes, d), h.dtype)
    out[at] = dh + p @ w["wc"].T
    out = across(out.reshape(steps, lanes, d))
    r, z = gates[:, :d], gates[:, d:]
    to_n, to_z, to_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), gn * r * (1 - r)
    own, into = np.empty((steps, 3 * d, lanes), h.dtype), np.empty((steps, 3 * d, lanes), h.dtype)
    back, turned, fresh = np.zeros((d, lanes), h.dtype), w["u"].T.copy().T, begins.any(axis=1)  # by columns, as in a product from the right
    for t in range(steps - 1, -1, -1):
        now, gate, part = out[t], own[t], into[t]
        now += back
        np.multiply(now, to_n[t], out=gate[2 * d :])
        np.multiply(gate[2 * d :], to_r[t], out=gate[:d])
        np.multiply(now, to_z[t], out=gate[d : 2 * d])
        part[: 2 * d] = gate[: 2 * d]
        np.multiply(gate[2 * d :], r[t], out=part[2 * d :])
        np.matmul(turned, part, out=back)
        now *= z[t]
        back += now
        if fresh[t]:
            back[:, begins[t]] = 0
    g["u"] = across(before).reshape(-1, d).T @ across(into).reshape(-1, 3 * d)
    rows, g["x"] = sums_by_row(across(own).reshape(-1, 3 * d), x.ravel())
    return g, rows, states[-1]


def gradients(w: dict, x: np.ndarray, y: np.ndarray, begins: np.ndarray, live: np.ndarray, h0: np.ndarray) -> tuple[dict, np.ndarray]:
    """The gradients of :func:`window_gradients` in the shape of the weights, and the last state."""
    g, rows, last = window_gradients(w, x, y, begins, live, h0)
    return g | {"x": dense_rows(w["x"], rows, g["x"])}, last


def dense_rows(like: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(like)
    out[rows] = values
    return out


def train_on(w: dict, ids: np.ndarray, offsets: np.ndarray, lanes: int = LANES // 4) -> dict:
    """One pass of AdaGrad over the texts."""
    w, seen = {k: v.copy() for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    packed = Lanes(ids, offsets, lanes)
    h = np.zeros((packed.lanes, HIDDEN), np.float32)
    for inputs, targets, begins, text in packed.windows(WINDOW):
        g, rows, h = window_gradients(w, inputs, targets, begins, text >= 0, h[: inputs.shape[1]])
        for k, v in g.items():
            step = v * v
            if k == "x":  # a row of no gradient stays as it is
                step += seen[k][rows]
                seen[k][rows] = step
            else:
                seen[k] += step
                step[:] = seen[k]
            np.sqrt(step, out=step)
            step += EPS
            v *= RATE
            np.divide(v, step, out=step)
            if k == "x":
                w[k][rows] -= step
            else:
                w[k] -= step
    return w


def text_scores(w: dict, ids: np.ndarray, offsets: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """log10 probability of every text under the model, over its whole length."""
    packed, out = Lanes(ids, offsets, lanes), np.zeros(len(offsets) - 1)
    h = np.zeros((packed.lanes, HIDDEN), np.float32)
    for inputs, targets, begins, text in packed.windows(4 * WINDOW):
        states, _ = run_window(w, inputs, begins, h[: inputs.shape[1]])
        h, text = states[-1], text.ravel()
        at = np.flatnonzero(text >= 0)
        score = log10_of(w, states.reshape(-1, HIDDEN)[at], targets.ravel()[at])
        out += np.bincount(text[at], weights=score, minlength=len(out))
    return out


def flat_of(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float64)


def weights_of(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, n`` of all words (and the end) of the training texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=32 << 20):
            codes, _, h = coded_tokens(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(codes, minlength=len(h)))], ["h", "n"])

    return text_rows(docs).filter(~held_out(F.col("doc_id"))).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def averaged(spark: SparkSession, trained: DataFrame) -> tuple[np.ndarray | None, float]:
    """Weighted sum of the tasks' weights, in two levels of partial sums."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0.0
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(w, np.float64)
                total, weight = own.copy() if total is None else total + own, weight + n
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([weight])], ["w", "n"])

    rows = trained.repartition(16).mapInArrow(add, "w binary, n double").repartition(1).mapInArrow(add, "w binary, n double").collect()
    return (np.frombuffer(rows[0].w, np.float64), rows[0].n) if rows else (None, 0.0)


def train(docs: DataFrame, counts: Counts) -> dict:
    spark, w = docs.sparkSession, initial(counts.by_id)
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(ROUNDS))
    rows = text_rows(docs).filter(~held_out(F.col("doc_id")))
    shared = spark.sparkContext.broadcast(counts)
    for k in range(ROUNDS):
        start = spark.sparkContext.broadcast(w)

        def learn(batches: Iterable[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, limit=SET_TOKENS * 6):
                codes, offsets, h = coded_tokens(batch.column(1))
                ids = shared.value.look_up(h)[2][codes]
                yield pa.RecordBatch.from_arrays([pa.array([(len(ids) * flat_of(train_on(start.value, ids, offsets))).tobytes()], pa.binary()), pa.array([float(len(ids))])], ["w", "n"])

        own = rows.filter(part == k)
        total, weight = averaged(spark, own.mapInArrow(learn, "w binary, n double"))
        if total is not None:
            w = weights_of(total / weight, w)
    return w


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark, root = docs.sparkSession, scratch(docs.sparkSession)
    table = stored(word_counts(docs), root, "counts")
    counts = Counts(table)
    shared, model = spark.sparkContext.broadcast(counts), spark.sparkContext.broadcast(train(docs, counts))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SET_TOKENS * 6):
            codes, offsets, h = coded_tokens(batch.column(1))
            top, n, ids = shared.value.look_up(h)
            logs, top, ids = np.log10(n + 1.0)[codes], top[codes], ids[codes]
            at = np.flatnonzero(~top)  # the others: each once a text, with how often
            rare, owner = h[codes[at]].view(np.int64), rows_at(offsets)[at]
            order = np.lexsort((rare, owner))
            rare, owner = rare[order], owner[order]
            new = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])])) if len(at) else at
            times = np.diff(np.append(new, len(at)))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=batch.num_rows))]), pa.int32())
            columns = {
                "doc_id": batch.column(0),
                "held_out": batch.column(2),
                "n_tokens": pa.array(np.diff(offsets)),
                "n_top": pa.array(row_sums(top, offsets)),
                "n_other": pa.array(row_sums(ids == OTHER, offsets)),
                "log_top": pa.array(row_sums(logs, offsets)),
                "log_other": pa.array(row_sums(np.where(ids == OTHER, logs, 0.0), offsets)),
                "model": pa.array(text_scores(model.value, ids, offsets)),
                "rare": pa.ListArray.from_arrays(ends, pa.array(rare[new])),
                "times": pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64))),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, held_out boolean, n_tokens long, n_top long, n_other long, log_top double, log_other double, model double, rare array<long>, times array<long>"
    scored = text_rows(docs, held_out(F.col("doc_id")).alias("held_out")).mapInArrow(score, schema)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), root, "scored")
    # Words beyond the top have small counts, so no key of this join is hot.
    rare = scored.select("row", F.explode(F.arrays_zip(F.col("rare").alias("h"), "times")).alias("w")).select("row", "w.h", "w.times")
    met = rare.join(table, "h").groupBy("row").agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_rare"))
    full = scored.drop("rare", "times").join(met, "row", "left").fillna(0, ["n_rare"]).fillna(0.0, ["log_rare"])
    others, kinds = float(counts.by_id[OTHER]), counts.distinct - counts.known
    base = F.col("log_top") + F.col("log_rare") - F.col("n_tokens") * F.log10(F.lit(float(counts.tokens + counts.distinct + 1)))
    whole = F.col("model") + F.col("log_other") + F.col("log_rare") - F.col("n_other") * F.log10(F.lit(others + kinds + 1))
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_top") + F.col("n_rare")).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), whole.alias("score")
    )
