"""Operator 1: hidden Markov language model.

Tokens are words between white space (A-Z lower-cased) and one end token per
text.  The HEAD commonest training tokens are emitted one by one, all others
by one tail symbol, inside which a token has its share by count (so a state
gives a tail token the tail's probability times that share, and unseen tokens
are part of the tail).  Emission, transition and start counts come from
Baum-Welch: every partition adds up its expected counts over whole training
texts, Spark sums them by symbol, and the driver holds the fixed-size
parameters only.  A text's log10 probability is exact, from the scaled forward
recursion.

Recursions run over segments of SEGMENT tokens of many texts at once: a
segment's product of transition and emission matrices carries the forward
vector of a text from one segment to the next (and the backward vector back),
then all segments are run through side by side.

The start values are seeded by the tokens' hashes; every round and all counts
cover all training texts, so neither a sample nor the files' layout has a part
in the model.

Training texts: crc32(doc_id as text) mod 5 is not 1 (a null id is training).
Base score: sum of log10((c + 0.5) / (N + 0.5 (V + 1))).

Defined cases: a null text is the empty text, of one token, the end; without
training tokens N = V = 0 and every token has probability 1; repeated rows are
kept and counted; columns beside doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import textbytes as B
from scrutin.llm.common import fold_of, stored

HEAD = (1 << 16) - 1
STATES = 6
ROUNDS = 5
SEGMENT = 2048
#: Vectors are scaled every so many steps; no emission is near 1e-38.
RESCALE = 8
SMOOTH = 0.5
END = np.uint64(0x5EED0F7E27C0DE01)
_BATCH_TOKENS = 1 << 20


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts of the partition's texts, in parts of bounded size."""
    held, size, ends = [], 0, 0

    def part() -> pa.RecordBatch:
        h = np.concatenate([x for x, _ in held])
        n = np.concatenate([c for _, c in held])
        by = np.argsort(h, kind="stable")
        h, n = h[by], n[by]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return pa.record_batch([pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(n, first))], names=["token", "n"])

    for batch in batches:
        for _, col in B.chunks(batch):
            w = B.words(col, B.SPACE)
            h, n = np.unique(w.hashes, return_counts=True)
            ends += len(col)
            if len(h):
                held.append((h, n.astype(np.int64)))
                size += len(h)
            if size > 1 << 21:
                yield part()
                held, size = [], 0
    if ends:
        held.append((np.array([END]), np.array([ends], np.int64)))
        yield part()


@dataclass
class Vocabulary:
    """The head tokens, by ascending hash, their counts, and the totals."""
    tokens: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int

    @property
    def tail(self) -> tuple[int, int]:
        return self.total - int(self.counts.sum()), self.distinct - len(self.tokens)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The head number of each token, the head's size for the others."""
        if not len(self.tokens):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
        return np.where(self.tokens[at] == hashes, at, len(self.tokens))


def _encoded(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocabulary.value
        log = np.log10(v.counts + 0.5) if len(v.counts) else np.zeros(1)
        for batch in batches:
            for part, col in B.chunks(batch):
                w = B.words(col, B.SPACE)
                ends = w.offsets[1:] + np.arange(len(col))
                n = np.diff(w.offsets) + 1
                off = np.concatenate([[0], np.cumsum(n)])
                h = np.insert(w.hashes, w.offsets[1:], END)
                s = v.symbols(h)
                known = s < len(v.tokens)
                doc = np.repeat(np.arange(len(col)), n)
                base = np.bincount(doc, np.where(known, log[np.minimum(s, len(log) - 1)], 0.0), minlength=len(col))
                heads = np.bincount(doc[known], minlength=len(col))
                rest, rd = h[~known], doc[~known]
                by = np.lexsort((rest, rd))
                rest, rd = rest[by], rd[by]
                first = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (rd[1:] != rd[:-1])])) if len(rest) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(rest)))
                lo = pa.array(np.searchsorted(rd[first], np.arange(len(col) + 1)).astype(np.int32))
                del ends
                ids = s.astype("<u2").tobytes()
                yield pa.record_batch([
                    part.column(0), part.column(1), part.column(2), pa.array(n), pa.array(heads), pa.array(base),
                    pa.array([ids[2 * a: 2 * b] for a, b in zip(off[:-1], off[1:])], pa.binary()),
                    pa.ListArray.from_arrays(lo, pa.array(rest[first].view(np.int64))),
                    pa.ListArray.from_arrays(lo, pa.array(times.astype(np.int32)))],
                    names=["rid", "doc_id", "held_out", "n_tokens", "n_head", "head_base", "symbols", "tail", "times"])
    return run


ENCODED = ("rid long, doc_id long, held_out boolean, n_tokens long, n_head long, head_base double, "
           "symbols binary, tail array<long>, times array<int>")


@dataclass
class Parameters:
    start: np.ndarray  # by state
    move: np.ndarray   # state to state
    emit: np.ndarray   # symbol by state


class _Layout:
    """Segments of symbols side by side, the longest first, time by time: the
    symbols that ``live[t]`` segments have at time t are ``flat[at[t]:at[t + 1]]``,
    so every step works on the first rows of its arrays."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(len(lengths), np.int64)
        self.rank[self.order] = np.arange(len(lengths))
        longest = int(lengths.max()) if len(lengths) else 0
        self.live = np.concatenate([np.cumsum(np.bincount(lengths, minlength=longest + 1)[::-1])[::-1][1:], [0]]).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.live)])
        n = int(lengths.sum())
        time = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.flat = np.empty(n, symbols.dtype)
        self.flat[self.at[time] + np.repeat(self.rank, lengths)] = symbols[np.repeat(starts, lengths) + time]

    def steps(self) -> Iterator[tuple[int, slice, int, int]]:
        """(time, its place in ``flat``, live segments, those that go on)."""
        for t in range(len(self.live) - 1):
            yield t, slice(self.at[t], self.at[t + 1]), self.live[t], self.live[t + 1]


class _Texts:
    """Texts cut in segments of at most SEGMENT symbols."""

    def __init__(self, sequences: list[np.ndarray]):
        n = np.array([len(x) for x in sequences], np.int64)
        self.count = -(-n // SEGMENT)
        self.first = np.cumsum(self.count) - self.count
        self.last = self.first + self.count - 1
        total = int(self.count.sum())
        inside = np.arange(total) - np.repeat(self.first, self.count)
        self.starts = np.repeat(np.cumsum(n) - n, self.count) + inside * SEGMENT
        self.lengths = np.minimum(np.repeat(n, self.count) - inside * SEGMENT, SEGMENT)
        self.symbols = np.concatenate(sequences)
        self.layout = _Layout(self.symbols, self.starts, self.lengths)


def _products(s: _Texts, some: np.ndarray, p: Parameters) -> np.ndarray:
    """The product of diag(emission) and transitions over each of some segments,
    from the state at its first token to that at the next segment's, scaled."""
    k = len(p.start)
    lay = _Layout(s.symbols, s.starts[some], s.lengths[some])
    m = np.broadcast_to(np.eye(k), (len(some), k, k)).copy()
    for t, place, live, _ in lay.steps():
        x = m[:live] * p.emit[lay.flat[place]][:, None, :]
        if t % RESCALE == RESCALE - 1:
            x /= x.max(axis=(1, 2), keepdims=True)
        m[:live] = (x.reshape(-1, k) @ p.move).reshape(-1, k, k)
    return m[lay.rank]


def _entries(s: _Texts, p: Parameters, backward: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The state distribution before each segment's first token and, if asked
    for, the scaled backward vector before the next segment's first emission
    (ones after a text's last)."""
    k, n = len(p.start), len(s.lengths)
    alpha = np.empty((n, k))
    alpha[s.first] = p.start
    beta = np.ones((n, k)) if backward else None
    long = np.flatnonzero(s.count > 1)
    if len(long):
        some = np.repeat(s.first[long] - (np.cumsum(s.count[long]) - s.count[long]), s.count[long]) + np.arange(int(s.count[long].sum()))
        place = np.empty(n, np.int64)
        place[some] = np.arange(len(some))
        m = _products(s, some, p)
        for i in range(1, int(s.count.max())):
            at = s.first[s.count > i] + i
            a = np.einsum("ni,nij->nj", alpha[at - 1], m[place[at - 1]])
            alpha[at] = a / a.sum(axis=1, keepdims=True)
        if backward:
            for i in range(1, int(s.count.max())):
                at = s.last[s.count > i] - i
                b = np.einsum("nij,nj->ni", m[place[at + 1]], beta[at + 1])
                beta[at] = b / b.sum(axis=1, keepdims=True)
    return alpha, beta


def _forward(s: _Texts, p: Parameters, entry: np.ndarray, kept: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The log probability of each segment given its entry, and the emissions of
    all symbols; ``kept`` takes the forward vectors, scaled every RESCALE steps."""
    lay = s.layout
    emit = p.emit[lay.flat]
    alpha, out = entry[lay.order], np.zeros(len(lay.order))
    for t, place, live, on in lay.steps():
        x = alpha[:live] * emit[place] if kept is None else np.multiply(alpha[:live], emit[place], out=kept[place])
        if t % RESCALE == RESCALE - 1:
            c = x.sum(axis=1)
            out[:live] += np.log(c)
            x /= c[:, None]
        if on < live:
            out[on:live] += np.log(x[on:].sum(axis=1))
        np.dot(x[:on], p.move, out=alpha[:on])
    return out[lay.rank], emit


def log_likelihood(sequences: list[np.ndarray], p: Parameters) -> np.ndarray:
    """The natural log probability of each sequence of symbols (the scaled
    forward recursion)."""
    s = _Texts(sequences)
    entry, _ = _entries(s, p, False)
    return np.add.reduceat(_forward(s, p, entry, None)[0], s.first)


def expected_counts(sequences: list[np.ndarray], p: Parameters) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected starts, moves and emissions, and the log likelihood."""
    s = _Texts(sequences)
    lay, k = s.layout, len(p.start)
    entry, beta = _entries(s, p, True)
    alphas = np.empty((len(lay.flat), k))
    out, emit = _forward(s, p, entry, alphas)
    goes_on = np.ones(len(s.lengths), bool)
    goes_on[s.last] = False
    beta, goes_on = beta[lay.order], goes_on[lay.order]
    final = np.where(goes_on[:, None], beta @ p.move.T, 1.0)   # the backward vector at each segment's last token
    moves, back, after = np.zeros((k, k)), np.empty_like(final), np.empty_like(final)
    for t, place, live, on in reversed(list(lay.steps())):
        a, b = alphas[place], back[:live]
        b[on:] = final[on:live]
        both = a * b
        scale = both.sum(axis=1, keepdims=True)
        over = a / scale
        moves += over[:on].T @ after[:on]
        ends = np.flatnonzero(goes_on[on:live])
        if len(ends):
            moves += over[on:][ends].T @ beta[on:live][ends]
        e = np.multiply(emit[place], b, out=after[:live])
        if t % RESCALE == 0:
            e /= e.sum(axis=1, keepdims=True)
        np.divide(both, scale, out=a)                          # from here on the posterior
        np.dot(e, p.move.T, out=back[:live])
    starts = alphas[lay.rank[s.first]].sum(axis=0)             # time 0 comes first, by rank
    emits = np.column_stack([np.bincount(lay.flat, alphas[:, j], minlength=len(p.emit)) for j in range(k)])
    return starts, moves * p.move, emits, float(out.sum())


def updated(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, background: np.ndarray) -> Parameters:
    """Parameters from expected counts; every state's emissions are drawn a
    little to the background distribution, so none is zero."""
    k = len(starts)
    weight = 0.02 * emits.sum(axis=0) + 1.0
    emit = (emits + background[:, None] * weight) / (emits.sum(axis=0) + weight)
    return Parameters((starts + 0.1) / (starts.sum() + 0.1 * k), (moves + 0.1) / (moves.sum(axis=1, keepdims=True) + 0.1 * k), emit)


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    held, seqs, size = [], [], 0
    for batch in batches:
        col, a = batch.column(batch.schema.get_field_index("symbols")).to_pylist(), 0
        for i, x in enumerate(col):
            seqs.append(np.frombuffer(x, "<u2"))
            size += len(seqs[-1])
            if size >= _BATCH_TOKENS:
                yield [*held, batch.slice(a, i + 1 - a)], seqs
                held, seqs, size, a = [], [], 0, i + 1
        if a < batch.num_rows:
            held.append(batch.slice(a))
    if seqs:
        yield held, seqs


def _expect(parameters):
    """Rows (symbol, expected emissions by state); symbol -1 has the starts,
    -2 and below the moves from each state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Parameters = parameters.value
        total = None
        for _, seqs in _batched(batches):
            got = expected_counts(seqs, p)[:3]
            total = got if total is None else tuple(x + y for x, y in zip(total, got))
        if total is not None:
            starts, moves, emits = total
            some = np.flatnonzero(emits.sum(axis=1) > 0)
            ids = np.concatenate([some, [-1], -2 - np.arange(len(starts))])
            rows = np.vstack([emits[some], starts[None], moves])
            yield pa.record_batch([pa.array(ids), *[pa.array(rows[:, j]) for j in range(rows.shape[1])]],
                                  names=["symbol", *[f"s{j}" for j in range(rows.shape[1])]])
    return run


def _score(parameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Parameters = parameters.value
        for parts, seqs in _batched(batches):
            ll = log_likelihood(seqs, p) / np.log(10.0)
            at = 0
            for part in parts:
                yield part.drop_columns(["symbols"]).append_column("path", pa.array(ll[at: at + part.num_rows]))
                at += part.num_rows
    return run


def _start(tokens: np.ndarray, background: np.ndarray, k: int) -> Parameters:
    """Start values: the background's emissions, each token's weights in the
    states seeded by its hash, and states that tend to stay."""
    seeds = np.append(tokens, np.uint64(0))[:, None] ^ B.mix(np.arange(1, k + 1, dtype=np.uint64))[None]
    emit = background[:, None] * np.log(B.unit(B.mix(seeds))) ** 2
    move = np.full((k, k), 0.02 / max(k - 1, 1))
    np.fill_diagonal(move, 0.98 if k > 1 else 1.0)
    return Parameters(np.full(k, 1.0 / k), move, emit / emit.sum(axis=0))


def lm_scores(documents: DataFrame, states: int = STATES, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = documents.sparkSession
    sc = spark.sparkContext
    docs = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(fold_of() == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    counts = stored(docs.where("not held_out").select("text").mapInArrow(_counts, "token long, n long")
                    .groupBy("token").agg(F.sum("n").alias("n")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the least bin of counts (64 to a doubling) from which on no more than HEAD tokens are left
    level = F.floor(64 * F.log2("n"))
    least, left = 1 << 30, head
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).orderBy(F.desc("level")).collect():
        left -= r.v
        if left < 0:
            break
        least = r.level
    top = counts.where(level >= least).collect()  # HEAD rows at most
    tokens = np.array([r.token for r in top], np.int64).view(np.uint64)
    by = np.argsort(tokens)
    voc = Vocabulary(tokens[by], np.array([r.n for r in top], np.int64)[by], int(total), int(distinct))
    encoded = stored(docs.mapInArrow(_encoded(sc.broadcast(voc)), ENCODED), "encoded")

    tail_n, tail_v = voc.tail
    norm = total + SMOOTH * (distinct + 1)
    background = np.append(voc.counts + SMOOTH, tail_n + SMOOTH * (tail_v + 1)) / norm
    train = encoded.where("not held_out").select("symbols")
    p = _start(voc.tokens, background, states)
    names = [f"s{j}" for j in range(states)]
    for _ in range(rounds if total else 0):
        rows = (train.mapInArrow(_expect(sc.broadcast(p)), "symbol long, " + ", ".join(f"{c} double" for c in names))
                .groupBy("symbol").agg(*[F.sum(c).alias(c) for c in names]).toPandas())  # one row per head symbol
        ids, values = rows["symbol"].to_numpy(), rows[names].to_numpy()
        emits, moves = np.zeros((len(background), states)), np.zeros((states, states))
        emits[ids[ids >= 0]] = values[ids >= 0]
        moves[-2 - ids[ids <= -2]] = values[ids <= -2]
        p = updated(values[ids == -1].sum(axis=0), moves, emits, background)

    scored = stored(encoded.mapInArrow(_score(sc.broadcast(p)), ENCODED.replace("symbols binary, ", "") + ", path double"), "scored")
    # the tail: each text's rare tokens meet their counts
    rare = (scored.select("rid", F.explode(F.arrays_zip("tail", "times")).alias("t"))
            .select("rid", F.col("t.tail").alias("token"), F.col("t.times").alias("times"))
            .join(counts, "token", "left").select("rid", "times", F.coalesce("n", F.lit(0)).alias("n")))
    rare = rare.groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("n") + SMOOTH)).alias("log"),
                                   F.sum("times").alias("rare"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"))
    log = F.coalesce("log", F.lit(0.0))
    tail_norm = float(np.log10(tail_n + SMOOTH * (tail_v + 1)))
    return scored.join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("head_base") + log - F.col("n_tokens") * float(np.log10(norm))).alias("base_score"),
        (F.col("path") + log - F.coalesce("rare", F.lit(0)) * tail_norm).alias("score"))
