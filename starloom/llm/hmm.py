"""Language model scores from a hidden Markov model over all training documents.

Words are counted in shards and over shards, in whole. The model has latent states that move from
word to word; a state emits a class of words, and the class emits the word by its count:

* each of the ``TOP`` most frequent words, and the end of a text, is a class of its own;
* any other word belongs to the class of its last two bytes, its first byte's kind and its length.

Baum-Welch: the class numbers of all training documents are written once; each pass runs forward and
backward over all of them in the tasks that read them, and adds up expected counts over partitions. The first pass starts
from ``new_model``; no sample is used. Long texts are worked on in pieces of ``PIECE`` tokens side by side: the
product of a piece's matrices carries the states over it, so that what each piece starts from and ends with
is that of the recursion over the whole text, and no move is lost at a border. Scores come from the scaled forward
recursion in the same way, so they are the exact logarithm of the model's probability. A class keeps the
mass of one more word for those never seen.

Defined results: a null or empty text has one token, the end. Rows that repeat an id count as often
as they stand there. Without training documents all words are unseen and every score is finite.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.shards import SHARD, announce, answer, sharded
from starloom.llm.text import Words, slices, words
from starloom.session import scratch_path

STATES = 8
TOP = 2000
SUFFIXES = 1024
PIECE = 512
BATCH_TOKENS = 1 << 20
NEAR = 48  # tokens on either side of a border that mostly settle its states
SETTLED = 1e-5
PASSES = 14
SHARD_BYTES = 8 << 20
END = np.uint64(0x2545F4914F6CDD1D)  # stands for the end of a text among the words' hashes


def suffix_classes(w: Words, at: np.ndarray) -> np.ndarray:
    """The class of the words at some places by their form."""
    start, end = w.start[at], w.end[at]
    tail = w.spans(np.maximum(end - 2, start), end)
    kind = w.data[start] >> 5 if len(at) else np.zeros(0, np.uint8)
    form = tail + kind.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.minimum(end - start, 6).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((form * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(54)).astype(np.int64)


@dataclass
class Model:
    top: np.ndarray  # sorted hashes of the words with a class of their own
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class by state

    def classes(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        at = pc.index_in(pa.array(hashes), value_set=pa.array(self.top))
        classes = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        rare = np.flatnonzero(classes < 0)
        classes[rare] = len(self.top) + 1 + suffix_classes(w, rare)
        return classes

    @property
    def end(self) -> int:
        return len(self.top)

    @property
    def n_classes(self) -> int:
        return len(self.top) + 1 + SUFFIXES


def new_model(top: np.ndarray) -> Model:
    rng = np.random.Generator(np.random.PCG64(7))
    n = len(top) + 1 + SUFFIXES
    emit = rng.gamma(2.0, size=(n, STATES))
    move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    flat = np.full(STATES, 1 / STATES)
    return Model(np.sort(top), flat, move, emit / emit.sum(axis=0))


def with_ends(values: np.ndarray, first: np.ndarray, end) -> np.ndarray:
    """The texts' tokens in a row with the end after each text."""
    return np.insert(values, first[1:], end)


class Pieces:
    """Texts of tokens cut in pieces of at most ``PIECE``, which are gone through step by step, side by side.

    Arrays over pieces and steps hold the states first, then all pieces' first steps, all second ones and so on;
    longer pieces come first, so that those that have a step ``t`` are the first ``active[t]``.
    """

    def __init__(self, classes: np.ndarray, first: np.ndarray, size: int):
        sizes = np.diff(first)
        count = -(-sizes // size)
        text = np.repeat(np.arange(len(sizes)), count)
        number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        length = np.minimum(sizes[text] - number * size, size)
        order = np.argsort(-length, kind="stable")
        self.text, self.number, self.length = text[order], number[order], length[order]
        begin = first[text[order]] + self.number * size
        self.last = self.number == count[self.text] - 1
        longest = int(self.length[0]) if len(self.length) else 0
        self.active = np.searchsorted(-self.length, -np.arange(longest), "left")
        self.offset = np.r_[0, np.cumsum(self.active)]
        self.symbols = np.concatenate([classes[begin[:n] + t] for t, n in enumerate(self.active)]) if longest else classes[:0]
        # where a piece of a number stands, for the pieces of texts of several
        many = np.flatnonzero(count[self.text] > 1)
        many = many[np.lexsort([self.text[many], self.number[many]])]
        self.rounds = np.split(many, np.flatnonzero(np.diff(self.number[many])) + 1) if len(many) else []
        self.place = {}
        for pieces in self.rounds:
            self.place.update(zip(zip(self.text[pieces].tolist(), self.number[pieces].tolist(), strict=True), pieces.tolist(), strict=True))

    def at(self, t: int) -> slice:
        return slice(self.offset[t], self.offset[t + 1])

    def following(self, pieces: np.ndarray, step: int) -> np.ndarray:
        """The pieces of the same texts with the next (or, with ``step`` -1, the last) numbers."""
        return np.array([self.place[t, n + step] for t, n in zip(self.text[pieces].tolist(), self.number[pieces].tolist(), strict=True)], np.int64)


def emissions(model: Model, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """State by class, each class over its largest, and the logs of these: no expected count changes by it."""
    largest = model.emit.max(axis=1)
    return np.ascontiguousarray((model.emit / largest[:, None]).T, kind), np.log(largest)


def _products(model: Model, cut: Pieces, emit: np.ndarray, chosen: np.ndarray, begin: int = 0, end: int | None = None):
    """The products of the matrices of some pieces (in order) scaled to sum 1, and the logs of their scales.

    From the states before a piece to those at its end; a text's first piece begins with the model's start. With ``begin`` and
    ``end``, of these steps alone.
    """
    length = cut.length[chosen] if end is None else np.minimum(cut.length[chosen], end)
    first = (cut.number[chosen] == 0) & (begin == 0)
    move = model.move.astype(emit.dtype)
    product = np.repeat(move.T[:, :, None], len(chosen), axis=2)  # state at the end, state before, piece
    product[:, :, first] = model.start.astype(emit.dtype)[:, None, None]
    logs = np.zeros(len(chosen))
    for t in range(begin, int(length[0])):
        n = int(np.searchsorted(-length, -t, "left"))
        if t > begin:
            part = (move.T @ product[:, :, :n].reshape(STATES, -1)).reshape(STATES, STATES, n)
        else:
            part = product[:, :, :n]
        part = part * emit[:, None, cut.offset[t] + chosen[:n]]
        if t % 4 == 3:
            scale = part.sum(axis=(0, 1))
            part /= scale
            logs[:n] += np.log(scale)
        product[:, :, :n] = part
    scale = product.sum(axis=(0, 1))
    return product / scale, logs + np.log(scale)


def _near_borders(model: Model, cut: Pieces, emit: np.ndarray, ended: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Fills in the states at borders that the ``NEAR`` tokens before and after them settle; the texts of the others.

    A product that gives the same states from whatever state it starts is that of all tokens up to there.
    """
    size = int(cut.length[0])
    many = np.sort(np.concatenate(cut.rounds))
    ending, beginning = many[~cut.last[many]], many[cut.number[many] > 0]
    product, _ = _products(model, cut, emit, ending, max(size - NEAR, 0), size)
    states = product / product.sum(axis=0)
    open_ends = np.abs(states - states[:, :1]).max(axis=(0, 1)) > SETTLED
    ended[:, cut.following(ending, 1)] = states.mean(axis=1)
    product, _ = _products(model, cut, emit, beginning, 0, NEAR)
    back = product / product.sum(axis=1, keepdims=True)
    open_starts = (np.abs(back - back[:1]).max(axis=(0, 1)) > SETTLED) & (cut.length[beginning] > NEAR)
    after[:, cut.following(beginning, -1)] = np.where(cut.length[beginning] > NEAR, back.mean(axis=0), product.sum(axis=0) / product.sum(axis=(0, 1)))
    # a product over all of a last piece, which nothing follows, needs no settling
    return np.unique(np.r_[cut.text[ending][open_ends], cut.text[beginning][open_starts]])


def _borders(model: Model, cut: Pieces, emit: np.ndarray, near: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each piece the states at the end of the piece before, those to go on from, what comes after it, and the log
    probability up to its end (0 for a text of one piece)."""
    n = len(cut.length)
    ended = np.full((STATES, n), 1 / STATES, emit.dtype)
    onward = np.repeat(model.start.astype(emit.dtype)[:, None], n, axis=1)
    after = np.ones((STATES, n), emit.dtype)
    logs = np.zeros(n)
    rounds = cut.rounds
    if near and rounds:
        unsettled = _near_borders(model, cut, emit, ended, after)
        inner = cut.number > 0
        onward[:, inner] = model.move.astype(emit.dtype).T @ ended[:, inner]
        rounds = [pieces[np.isin(cut.text[pieces], unsettled)] for pieces in rounds]
        rounds = [pieces for pieces in rounds if len(pieces)]
        after[:, cut.last] = 1
    if not rounds:
        return ended, onward, after, logs
    chosen = np.sort(np.concatenate(rounds))
    product, scales = _products(model, cut, emit, chosen)
    row = np.zeros(n, np.int64)
    row[chosen] = np.arange(len(chosen))
    end = np.zeros((STATES, n), emit.dtype)
    for number, pieces in enumerate(rounds):
        part = product[:, :, row[pieces]]
        if number == 0:
            state = part[:, 0, :]  # the same whatever stood before
            logs[pieces] = scales[row[pieces]]
        else:
            before = cut.following(pieces, -1)
            ended[:, pieces] = end[:, before]
            onward[:, pieces] = model.move.astype(emit.dtype).T @ end[:, before]
            state = np.einsum("jin,in->jn", part, end[:, before])
            logs[pieces] = logs[before] + scales[row[pieces]]
        total = state.sum(axis=0)
        logs[pieces] += np.log(total)
        end[:, pieces] = state / total
    for pieces in reversed(rounds):
        going = pieces[~cut.last[pieces]]
        if len(going):
            beyond = cut.following(going, 1)
            back = np.einsum("jin,jn->in", product[:, :, row[beyond]], after[:, beyond])
            after[:, going] = back / back.sum(axis=0)
    return ended, onward, after, logs


def expected_counts(model: Model, classes: np.ndarray, first: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, ...]:
    """Expected counts of starts, moves and emissions over whole texts of tokens."""
    starts, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model.emit.shape)
    cut = Pieces(classes, first, size)
    if not len(cut.length):
        return starts, moves, emits
    table, _ = emissions(model, np.float32)
    emit = np.take(table, cut.symbols, axis=1)
    ended, state, after, _ = _borders(model, cut, emit, near=True)
    move = model.move.astype(np.float32)
    forward = np.empty_like(emit)
    scales = np.ones(emit.shape[1], np.float32)
    for t, n in enumerate(cut.active):
        at = cut.at(t)
        state = np.multiply(move.T @ state[:, :n] if t else state, emit[:, at], out=forward[:, at])
        if t % 2 == 0:  # two steps do not leave the range of single precision
            scales[at] = state.sum(axis=0)
            state /= scales[at]
    back = None
    seen = np.zeros((STATES, STATES))
    gamma = np.empty_like(emit)
    for t in range(len(cut.active) - 1, -1, -1):
        n, at = cut.active[t], cut.at(t)
        # pieces that end here go on from what comes after them
        m = 0 if back is None else back.shape[1]
        now = move @ back if m else after[:, :0]
        if t % 2 and m:
            now /= now.sum(axis=0)
        if m < n:
            now = np.concatenate([now, after[:, m:n]], axis=1)
        both = np.multiply(forward[:, at], now, out=gamma[:, at])
        share = 1 / both.sum(axis=0)
        both *= share
        back = now * emit[:, at]
        # the probability of the step into this token, over that of the state and what follows
        share /= scales[at]
        if t:
            before = forward[:, cut.offset[t - 1] : cut.offset[t - 1] + n]
            seen += before @ (back * share).T
        else:
            inner = cut.number[:n] > 0
            if inner.any():
                seen += ended[:, inner] @ (back * share)[:, inner].T
    moves += seen * model.move
    for k in range(STATES):
        emits[:, k] = np.bincount(cut.symbols, gamma[k], minlength=len(emits))
    starts += gamma[:, : cut.active[0]][:, cut.number == 0].sum(axis=1)
    return starts, moves, emits


def improved(model: Model, counts: tuple[np.ndarray, ...]) -> Model:
    """The model that the expected counts make likeliest, with a little mass for what was not seen."""
    starts, moves, emits = counts
    start, move, emit = starts + 0.1, moves + 0.1, emits + 0.01
    return Model(model.top, start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def log_forward(model: Model, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log probability of each text's classes: the scaled forward recursion over whole texts."""
    total = np.zeros(len(first) - 1)
    cut = Pieces(classes, first, PIECE)
    if not len(cut.length):
        return total
    table, largest = emissions(model, np.float64)
    emit = np.take(table, cut.symbols, axis=1)
    _, _, _, logs = _borders(model, cut, emit)
    # the product of a long text's pieces has its sum; the others are gone through
    several = np.zeros(len(cut.length), bool)
    several[[i for pieces in cut.rounds for i in pieces]] = True
    alone = np.flatnonzero(~several)
    length = cut.length[alone]
    state = np.repeat(model.start[:, None], len(alone), axis=1)
    for t in range(int(length[0]) if len(alone) else 0):
        n = int(np.searchsorted(-length, -t, "left"))
        state = (model.move.T @ state[:, :n] if t else state) * emit[:, cut.offset[t] + alone[:n]]
        scale = state.sum(axis=0)
        state /= scale
        logs[alone[:n]] += np.log(scale)
    total[cut.text[cut.last]] = logs[cut.last]
    tokens = np.r_[0.0, np.cumsum(largest[classes])]
    return total + tokens[first[1:]] - tokens[first[:-1]]


def _pack(counts: tuple[np.ndarray, ...]) -> bytes:
    return np.concatenate([c.ravel() for c in counts]).astype(np.float32).tobytes()


def _unpack(packed: bytes, n_classes: int) -> tuple[np.ndarray, ...]:
    flat = np.frombuffer(packed, np.float32).astype(float)
    starts, moves, emits = np.split(flat, np.cumsum([STATES, STATES * STATES]))
    return starts, moves.reshape(STATES, STATES), emits.reshape(n_classes, STATES)


def encoded(texts: DataFrame, model: Model) -> DataFrame:
    """The class numbers of every text's tokens (``ids``, 16 bits each), as the model's passes read them."""
    shared = texts.sparkSession.sparkContext.broadcast(Model(model.top, model.start, model.move, model.emit[:, :1]))

    def each(batches):
        for batch in batches:
            for _, part in slices(batch[0]):
                w = words(part, fold=True)
                ids = with_ends(shared.value.classes(w, w.hashes()), w.first, shared.value.end).astype("<u2")
                ends = (w.first + np.arange(len(w.first))) * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())],
                    ["ids"],
                )

    return texts.mapInArrow(each, "ids binary")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a batch of encoded texts in a row, and where each text begins."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, "<u2", count=(bounds[-1] - bounds[0]) // 2, offset=bounds[0]) if data is not None else np.zeros(0, "<u2")
    return raw.astype(np.int64), (bounds - bounds[0]) // 2


def baum_welch_pass(texts: DataFrame, model: Model) -> Model:
    """One pass over encoded texts: counts are added up in each task, then over tasks."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        model, total = shared.value, None
        for batch in batches:
            classes, first = _tokens(batch["ids"])
            # whole texts of about so many tokens at a time
            row = 0
            while row < len(first) - 1:
                stop = max(row + 1, int(np.searchsorted(first, first[row] + BATCH_TOKENS, "right")) - 1)
                counts = expected_counts(model, classes[first[row] : first[stop]], first[row : stop + 1] - first[row])
                total = counts if total is None else tuple(a + b for a, b in zip(total, counts, strict=True))
                row = stop
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([_pack(total)])], ["one", "counts"])

    def add(batches):
        total = None
        for batch in batches:
            for packed in batch["counts"].to_pylist():
                counts = np.frombuffer(packed, np.float32)
                total = counts.astype(float) if total is None else total + counts
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.astype(np.float32).tobytes()])], ["one", "counts"])

    schema = "one long, counts binary"
    parts = texts.mapInArrow(each, schema)
    # a matrix of fixed size from each task: a few tasks add them up before the driver does
    some = parts.repartition(8).mapInArrow(add, schema)
    packed = [r.counts for r in some.collect()]
    if not packed:
        return model
    n = model.n_classes
    return improved(model, tuple(sum(c) for c in zip(*[_unpack(p, n) for p in packed], strict=True)))


COUNTED = f"{SHARD} long, key long, form int, n long"
SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _count(text_col: str, train_col: str):
    def work(table):
        keys, forms, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        train = table[train_col].to_numpy()
        for row, part in slices(table[text_col]):
            w = words(part, fold=True)
            hashes = w.hashes()
            found = pa.array(hashes).dictionary_encode()
            distinct, at = found.dictionary.to_numpy(), found.indices.to_numpy()
            first = np.zeros(len(distinct), np.int64)
            first[at[::-1]] = np.arange(len(at))[::-1]
            keys.append(distinct)
            forms.append(suffix_classes(w, first))
            used = train[row : row + len(part)][w.text_of]
            seen.append(np.bincount(at, used, minlength=len(distinct)).astype(np.int64))
        keys, forms, seen = np.concatenate(keys), np.concatenate(forms), np.concatenate(seen)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(inverse, seen, minlength=len(distinct)).astype(np.int64)
        distinct, forms = np.r_[distinct, END], np.r_[forms[first], -1]
        n = np.r_[n, int(train.sum())]
        shard = np.full(len(n), table[SHARD][0].as_py(), np.int64)
        arrays = [pa.array(shard), pa.array(distinct.view(np.int64)), pa.array(forms.astype(np.int32)), pa.array(n)]
        return pa.Table.from_arrays(arrays, [SHARD, "key", "form", "n"])

    return work


def score(docs: DataFrame, train, *, id_col="doc_id", text_col="text", passes=PASSES, shard_bytes=SHARD_BYTES) -> DataFrame:
    """Log10 probabilities of every document under the model learned from those for which ``train`` holds.

    ``train`` is a boolean column. Returns the id, token counts, the unigram base score and the model's score.
    """
    spark = docs.sparkSession
    held = docs.select(id_col, text_col, F.coalesce(train, F.lit(False)).alias("_train"))
    shards = sharded(held, id_col, text_col, shard_bytes)
    by_key = Window.partitionBy("key")
    counted = announce(shards, _count(text_col, "_train"), COUNTED)
    # every shard gets the total of each of its words; the shard of the smallest number stands for the word in sums
    path = scratch_path(spark, "word-counts")
    counted.select(
        SHARD, "key", "form", F.sum("n").over(by_key).alias("n"), (F.min(SHARD).over(by_key) == F.col(SHARD)).alias("one")
    ).write.parquet(path)
    totals = spark.read.parquet(path)
    known = totals.where("one and n > 0")
    top = known.where("form >= 0").orderBy(F.desc("n"), "key").select("key", "form", "n").limit(TOP).collect()
    top_keys = np.array([r.key for r in top], np.int64).view(np.uint64)
    model = new_model(top_keys)

    forms = {r.form: (r.tokens, r.types) for r in known.groupBy("form").agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).collect()}
    train_tokens = sum(t for t, _ in forms.values())
    train_types = sum(t for _, t in forms.values())
    form_tokens, form_types = np.zeros(SUFFIXES), np.zeros(SUFFIXES)
    for form, (tokens, types) in forms.items():
        if form >= 0:
            form_tokens[form], form_types[form] = tokens, types
    for r in top:  # these have left their form for a class of their own
        form_tokens[r.form] -= r.n
        form_types[r.form] -= 1
    form_logs = np.log(form_tokens + form_types + 1)

    training = stored(encoded(held.where("_train").select(F.col(text_col).alias("text")), model), "encoded")
    for _ in range(passes):
        model = baum_welch_pass(training, model)
    shared = spark.sparkContext.broadcast((model, form_logs))
    base_log = np.log10(train_tokens + train_types + 1)

    def scored(table, answers):
        model, form_logs = shared.value
        keys = pa.array(answers["key"].to_numpy().view(np.uint64))
        n = answers["n"].to_numpy().astype(np.float64)
        columns = [[] for _ in range(5)]
        for _, part in slices(table[text_col]):
            w = words(part, fold=True)
            hashes = w.hashes()
            classes = model.classes(w, hashes)
            at = pc.index_in(pa.array(with_ends(hashes, w.first, END)), value_set=keys)
            count = np.r_[n, 0.0][pc.fill_null(at, len(n)).to_numpy()]
            first = w.first + np.arange(len(w.first))
            all_classes = with_ends(classes, w.first, model.end)
            form = all_classes - len(model.top) - 1
            inside = np.where(form >= 0, np.log(count + 1) - form_logs[np.maximum(form, 0)], 0.0)
            logs = [np.add.reduceat(x, first[:-1]) for x in (np.log10(count + 1), inside)]
            tokens = np.diff(first)
            columns[0].append(tokens)
            columns[1].append(np.add.reduceat((count > 0).astype(np.int64), first[:-1]))
            columns[2].append(np.full(len(tokens), train_tokens, np.int64))
            columns[3].append(logs[0] - tokens * base_log)
            columns[4].append((log_forward(model, all_classes, first) + logs[1]) / np.log(10))
        arrays = [pa.array(np.concatenate(c) if c else np.zeros(0)) for c in columns]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        arrays = [a.cast(k) for a, k in zip(arrays, kinds, strict=True)]
        return pa.Table.from_arrays([pa.chunked_array(table[id_col].chunks, table[id_col].type), *arrays], [id_col, *[c.split()[0] for c in SCORED.split(", ")]])

    kind = docs.schema[id_col].dataType.simpleString()
    return answer(shards, totals.select(SHARD, "key", "n"), scored, f"`{id_col}` {kind}, {SCORED}")
