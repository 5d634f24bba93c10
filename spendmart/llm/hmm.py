"""Hidden Markov language model: trained by Baum-Welch over all training texts, scored exactly.

1. Words of the training texts are counted, each task's first. The commonest words (``COMMON`` at
   most, all that reach some count) go to the tasks with their counts.
2. Each text is read once more and written as symbols: one for each of the ``OWN`` commonest words,
   one for the end, and ``CLASSES`` for all other words, by their ending and length. A state emits
   symbols; within a class a word has its smoothed share of the class, whatever the state. Words
   that aren't among the commonest meet their counts in a join, once per text and word.
3. A round of Baum-Welch adds up every task's expected starts, transitions and emissions under the
   present model. They are added as whole 2^-16ths, so that no order of tasks changes the model. The
   driver holds the model only, whose size is fixed by ``OWN``, ``CLASSES`` and the states.
4. A text's score is its exact likelihood by the scaled forward recursion, times its words' shares in
   their classes. Long texts pass in segments; only the states at their borders are kept.

Words are named by 64-bit hashes, equal on every machine; two of V words share one with probability
V^2 / 2^65.

Defined results: null, empty and wordless texts are one token, the end; a null id is hashed as empty
text; repeated rows of an id are texts of their own; without training texts every word is unknown,
N and V are 0 and the model is uniform; an empty table gives an empty result; columns other than id
and text are not read, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import Words, chunks, compactly_staged, lean, mixed
from spendmart.staging import staged

#: Words with a symbol of their own, symbols for the rest, and words whose counts tasks hold.
OWN, CLASSES, COMMON = 32_768, 1_024, 262_144
#: Tokens that are swept together, and cells (tokens under way) of a segment of the sweep.
BUFFER, CELLS = 1 << 22, 1 << 18
#: Expected counts are added as whole multiples of one over this.
UNIT = 1 << 16
#: Class of the row that counts the ends of texts.
END = -1
SYMBOL_TYPE = np.uint16


def classes_of(words: Words) -> np.ndarray:
    """Each word's class: its last two bytes and its length, hashed."""
    raw = np.frombuffer(words.data, np.uint8).astype(np.uint64)
    length = words.ends - words.starts
    before = np.where(length > 1, raw[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    shape = raw[words.ends - 1] << np.uint64(16) | before << np.uint64(8) | (np.minimum(length, 15) // 3).astype(np.uint64)
    return (mixed(shape) % np.uint64(CLASSES)).astype(np.int16)


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names, kinds, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(names, kind="stable")
    names, kinds, counts = names[order], kinds[order], counts[order]
    begins = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, int)
    return names[begins], kinds[begins], np.add.reduceat(counts, begins) if len(begins) else counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name, class, n of this task's words; more than once where it has very many different ones."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = texts = 0

    def rows(names: np.ndarray, kinds: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(names.view(np.int64)), pa.array(kinds, pa.int16()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["name", "class", "n"])

    for batch in batches:
        for _, part in chunks(batch.column(0).to_pylist()):
            texts += len(part)
            words = Words(part, lower=True)
            if len(words.names):
                names, first, counts = np.unique(words.names, return_index=True, return_counts=True)
                held.append((names, classes_of(words)[first], counts.astype(np.int64)))
                size += len(names)
        if size > 1 << 21:
            held = [_merged(held)]
            size = len(held[0][0])
            if size > 1 << 20:
                yield rows(*held[0])
                held, size = [], 0
    if held:
        yield rows(*_merged(held))
    if texts:
        yield rows(np.zeros(1, np.uint64), np.array([END], np.int16), np.array([texts], np.int64))


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs to know of the words: the commonest ones by name, and the classes' sums."""

    names: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    own_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_texts: int
    n_tokens: int
    n_words: int

    @property
    def n_symbols(self) -> int:
        return 1 + len(self.own_counts) + CLASSES

    def shares(self) -> np.ndarray:
        """Smoothed share of each symbol in all training tokens."""
        seen = np.concatenate([[self.n_texts], self.own_counts, self.class_tokens]) + 1.0
        return seen / seen.sum()


def magnitude(n: str) -> Column:
    """Counts in eighths of a power of two: few values, in the counts' order."""
    return F.floor(F.log2(F.col(n).cast("double")) * 8).cast("int")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the counts of the words that are not among the commonest."""
    sums = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()  # a row a class
    words = counts.where(F.col("class") != END).withColumn("size", magnitude("n"))
    least, held = 1 << 30, 0
    for size, n in sorted(words.groupBy("size").count().collect(), reverse=True):  # some hundred rows at most
        if held + n > COMMON:
            break
        least, held = size, held + n
    table = words.where(F.col("size") >= least).select("name", "class", "n").toArrow()  # COMMON rows at most
    names, kinds, ns = (table.column(c).to_numpy() for c in ("name", "class", "n"))
    names, kinds = names.astype(np.int64).view(np.uint64), kinds.astype(np.int64)
    order = np.lexsort((names, -ns))
    names, kinds, ns = names[order], kinds[order], ns[order]
    own = min(OWN, len(names))
    symbols = np.concatenate([np.arange(1, own + 1), own + 1 + kinds[own:]]).astype(SYMBOL_TYPE)
    tokens, different = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    n_texts = 0
    for kind, n, n_words in sums:
        if kind == END:
            n_texts = n
        else:
            tokens[kind], different[kind] = n, n_words
    total, all_words = int(tokens.sum()) + n_texts, int(different.sum()) + (n_texts > 0)
    np.subtract.at(tokens, kinds[:own], ns[:own])
    np.subtract.at(different, kinds[:own], 1)
    by_name = np.argsort(names)
    found = Vocabulary(names[by_name], ns[by_name], symbols[by_name], ns[:own], tokens, different, n_texts, total, all_words)
    return found, words.where(F.col("size") < least).select("name", F.col("n").alias("c"))


_ENCODED = "id {}, trained boolean, n_tokens bigint, n_known bigint, logs double, tied double, symbols binary, names array<bigint>, times array<int>"


def _encode(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        own = len(v.own_counts)
        in_class = np.log10(v.class_tokens + v.class_words + 1.0)
        common_logs = np.log10(v.counts + 1.0)
        end_log = np.log10(v.n_texts + 1.0)
        for batch in batches:
            for first, part in chunks(batch.column(2).to_pylist()):
                words = Words(part, lower=True)
                kinds = classes_of(words).astype(np.int64)
                if len(v.names):
                    at = np.minimum(np.searchsorted(v.names, words.names), len(v.names) - 1)
                    hit = v.names[at] == words.names
                else:
                    at, hit = np.zeros(len(words.names), int), np.zeros(len(words.names), bool)
                symbols = (own + 1 + kinds).astype(SYMBOL_TYPE)
                symbols[hit] = v.symbols[at[hit]]
                logs = np.zeros(len(at))
                logs[hit] = common_logs[at[hit]]
                tied = np.where(symbols > own, logs - in_class[kinds], 0.0)
                columns: list[list] = [[] for _ in range(7)]
                for a, b in zip(words.bounds[:-1], words.bounds[1:]):
                    rare = words.names[a:b][~hit[a:b]]
                    names, times = np.unique(rare, return_counts=True)
                    row = (
                        b - a + 1, b - a - len(rare) + (v.n_texts > 0), float(logs[a:b].sum() + end_log), float(tied[a:b].sum()),
                        np.append(symbols[a:b], SYMBOL_TYPE(0)).tobytes(), names.view(np.int64), times.astype(np.int32),
                    )
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds_of = [pa.int64()] * 2 + [pa.float64()] * 2 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds_of)]
                ids = [batch.column(i).slice(first, len(part)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*ids, *arrays],
                    names=["id", "trained", "n_tokens", "n_known", "logs", "tied", "symbols", "names", "times"],
                )

    return encode


@dataclass(frozen=True)
class Model:
    """Probabilities of the first state, of the next one (rows: present state), and of symbols by state."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # a row a symbol

    @classmethod
    def begin(cls, shares: np.ndarray, states: int, seed: int) -> Model:
        """States that tend to stay, and differ in which symbols they favour."""
        rng = np.random.default_rng(seed)
        emit = shares[:, None] * np.exp(rng.normal(0.0, 1.0, (len(shares), states)))
        step = np.full((states, states), 0.2 / states) + np.eye(states) * 0.8
        return cls(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(0))

    def after(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray, shares: np.ndarray, smooth: float) -> Model:
        """The model of these expected counts, smoothed towards the symbols' overall shares."""
        start, step, emit = start + 1.0, step + 1.0, emit + smooth * shares[:, None]
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


class Sweep:
    """Texts side by side, longest first: the cells of a step are the texts that still go on."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts])
        self.order = np.argsort(-lengths, kind="stable")
        self.steps = int(lengths.max())
        self.active = len(texts) - np.cumsum(np.bincount(lengths, minlength=self.steps + 1))[: self.steps]
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        self.symbols = np.empty(self.at[-1], SYMBOL_TYPE)
        for place, i in enumerate(self.order):
            self.symbols[self.at[: len(texts[i])] + place] = texts[i]

    def segments(self) -> list[tuple[int, int]]:
        out, t = [], 0
        while t < self.steps:
            u = min(self.steps, t + min(max(CELLS // int(self.active[t]), 16), 1024))
            out.append((t, u))
            t = u
        return out

    def forward(self, t0: int, t1: int, last: np.ndarray | None, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emissions, scaled forward probabilities and scales of the segment's cells.

        ``last`` has the forward probabilities of the step before.
        """
        base = self.at[t0]
        emit = model.emit[self.symbols[base : self.at[t1]]]
        alpha, scale = np.empty_like(emit), np.empty(len(emit))
        ones = np.ones(emit.shape[1])
        for t in range(t0, t1):
            low, n = self.at[t] - base, self.active[t]
            now = alpha[low : low + n]
            if last is None:
                np.multiply(emit[low : low + n], model.start, out=now)
            else:
                np.matmul(last[:n], model.step, out=now)
                now *= emit[low : low + n]
            total = now @ ones
            scale[low : low + n] = total
            now /= total[:, None]
            last = now
        return emit, alpha, scale

    def likelihoods(self, model: Model) -> np.ndarray:
        """log10 of the probability of each text, in the order given."""
        found, last = np.zeros(len(self.order)), None
        for t0, t1 in self.segments():
            _, alpha, scale = self.forward(t0, t1, last, model)
            active = self.active[t0:t1]
            place = np.arange(len(scale)) - np.repeat(self.at[t0:t1] - self.at[t0], active)
            found += np.bincount(place, np.log10(scale), len(found))
            last = alpha[len(alpha) - active[-1] :].copy()
        out = np.empty_like(found)
        out[self.order] = found
        return out

    def expected(self, model: Model, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected starts and transitions; expected emissions are added to ``emitted``."""
        segments = self.segments()
        before: list[np.ndarray | None] = [None]
        for t0, t1 in segments[:-1]:
            _, alpha, _ = self.forward(t0, t1, before[-1], model)
            before.append(alpha[len(alpha) - self.active[t1 - 1] :].copy())
        step = np.zeros_like(model.step)
        message: np.ndarray | None = None
        for (t0, t1), last in zip(reversed(segments), reversed(before)):
            base = self.at[t0]
            emit, alpha, scale = self.forward(t0, t1, last, model)
            emit /= scale[:, None]
            beta = np.ones_like(emit)
            if message is not None:
                low, n = self.at[t1 - 1] - base, len(message)
                beta[low : low + n] = message @ model.step.T
                step += alpha[low : low + n].T @ message
            for t in range(t1 - 1, t0, -1):
                low, n, earlier = self.at[t] - base, self.active[t], self.at[t - 1] - base
                now = emit[low : low + n]
                now *= beta[low : low + n]
                np.matmul(now, model.step.T, out=beta[earlier : earlier + n])
            first = int(self.active[t0])
            message = emit[:first] * beta[:first]
            left = np.arange(first, len(emit)) - np.repeat(self.active[t0 : t1 - 1], self.active[t0 + 1 : t1])
            step += alpha[left].T @ emit[first:]
            alpha *= beta
            symbols = self.symbols[base : self.at[t1]]
            for k in range(alpha.shape[1]):
                emitted[:, k] += np.bincount(symbols, alpha[:, k], len(emitted))
        return alpha[: self.active[0]].sum(0), step * model.step


def _buffers(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[np.ndarray], list[pa.RecordBatch]]]:
    """Texts of about ``BUFFER`` tokens together, with the batches they came in."""
    texts: list[np.ndarray] = []
    came: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        texts += [np.frombuffer(row.as_buffer(), SYMBOL_TYPE) for row in batch.column(column)]
        came.append(batch)
        size += batch.column(column).nbytes // SYMBOL_TYPE().itemsize
        if size >= BUFFER:
            yield texts, came
            texts, came, size = [], [], 0
    if texts:
        yield texts, came


def _round(trained: DataFrame, model: Model, v: Vocabulary, smooth: float) -> Model:
    """One round of Baum-Welch over ``trained`` (symbols)."""
    states = len(model.start)
    shared = trained.sparkSession.sparkContext.broadcast(model)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Model = shared.value
        emitted = np.zeros_like(now.emit)
        start, step = np.zeros(states), np.zeros((states, states))
        for texts, _ in _buffers(batches, 0):
            more_start, more_step = Sweep(texts).expected(now, emitted)
            start += more_start
            step += more_step
        # rows: symbols, then transitions from each state, then starts
        counts = np.rint(np.concatenate([emitted, step, start[None]]) * UNIT).astype(np.int64)
        rows = np.flatnonzero(counts.any(1))
        columns = [pa.array(rows, pa.int32()), *(pa.array(counts[rows, k]) for k in range(states))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"s{k}" for k in range(states))])

    schema = "row int, " + ", ".join(f"s{k} bigint" for k in range(states))
    sums = trained.select("symbols").mapInArrow(lean(expect), schema).groupBy("row").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states)))
    table = sums.toArrow()  # a row a symbol and state
    counts = np.zeros((v.n_symbols + states + 1, states))
    counts[table.column("row").to_numpy()] = np.stack([table.column(f"s{k}").to_numpy() for k in range(states)], 1) / UNIT
    shared.unpersist()
    return model.after(counts[-1], counts[v.n_symbols : -1], counts[: v.n_symbols], v.shares(), smooth)


def encoded(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """``docs`` (id, trained, text) as symbols, with what counts say of their words; written, with a row number."""
    shared = docs.sparkSession.sparkContext.broadcast(v)
    id_type = docs.schema["id"].dataType.simpleString()
    made = docs.select("id", "trained", "text").mapInArrow(lean(_encode(shared)), _ENCODED.format(id_type))
    return compactly_staged(made.withColumn("row", F.monotonically_increasing_id()), "symbols")


def trained_model(texts: DataFrame, v: Vocabulary, *, states: int, rounds: int, smooth: float, seed: int) -> Model:
    """The model after ``rounds`` rounds over ``texts`` (symbols)."""
    model = Model.begin(v.shares(), states, seed)
    # every task sends sums as large as the model, so a task takes some millions of tokens
    tasks = max(2 * texts.sparkSession.sparkContext.defaultParallelism, v.n_tokens // BUFFER)
    texts = texts.coalesce(tasks)
    for _ in range(rounds if v.n_texts else 0):
        model = _round(texts, model, v, smooth)
    return model


def scored(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_fold: int = 2,
    states: int = 8,
    rounds: int = 5,
    smooth: float = 5000.0,
    seed: int = 12,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the model's; texts whose id's
    crc32 leaves ``held_fold`` when divided by ``folds`` are scored but not learned from.
    """
    trained = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds != held_fold
    texts = docs.select(F.col(id_col).alias("id"), trained.alias("trained"), F.col(text_col).cast("string").cast("binary").alias("text"))
    counted = texts.where("trained").select("text").mapInArrow(lean(_count_words), "name bigint, class smallint, n bigint")
    counts = staged(counted.groupBy("name", "class").agg(F.sum("n").alias("n")), "word-counts")
    v, uncommon = vocabulary(counts)
    symbols = encoded(texts, v)
    model = trained_model(symbols.where("trained").select("symbols"), v, states=states, rounds=rounds, smooth=smooth, seed=seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, came in _buffers(batches, 1):
            rows = pa.concat_arrays([batch.column(0) for batch in came])
            found = pa.array(Sweep(texts).likelihoods(shared.value))
            yield pa.RecordBatch.from_arrays([rows, found], names=["row", "likelihood"])

    likely = symbols.select("row", "symbols").mapInArrow(lean(likelihood), "row bigint, likelihood double")
    words = symbols.select("row", F.explode(F.arrays_zip("names", "times")).alias("w")).select("row", "w.names", "w.times")
    met = words.join(uncommon, words["names"] == uncommon["name"])
    rare = met.groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"))
    out = symbols.drop("symbols", "names", "times").join(likely, "row").join(rare, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    all_log = F.log10(F.lit(float(v.n_tokens + v.n_words + 1)))
    return out.select(
        F.col("id").alias(id_col),
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(v.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("likelihood") + F.col("tied") + more).alias("score"),
    )
