"""Scoring texts with Brown class-based bigrams.

The most frequent words are put into classes by the exchange algorithm, which moves one word at a time to the
class that raises the likelihood of the class bigrams most. Every other training word then joins the class that
suits the classes beside it best, and the transitions are counted again with all words in classes. A token's
probability is that of its class after the class before, times that of the word in its class. Words that training
never saw form a class of their own, which stands where words seen once stand.

Corpus counts cover every training document. Texts are split into words twice: once to count them, once to write
every text as numbers, from which all else is taken. Tasks look up the most frequent words in a table of bounded
size; the others, whose number has no bound, meet their classes and counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.storage import landed
from flightlake.llm.text import bucket, table

#: Words put into classes by exchange, and their classes.
CLASS_WORDS, CLASSES = 2000, 48
#: Most frequent words that every task holds with their counts.
HELD_WORDS = 150_000
#: Weight of the class's own frequency in the smoothed transitions.
PRIOR = 5.0
#: Bytes of word numbers looked at together.
RUN_BYTES = 1 << 23
#: Distinct words that a counting task holds before it passes them on.
FLUSH = 400_000
#: In a path of classes, one byte a token: the mark of a word seen once.
ONCE = 128


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def flush(count: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64())], schema)

    count: Counter = Counter()
    for batch in batches:
        for _, part in slices(batch.column(0).cast(pa.binary()).to_pylist()):
            for t in part:
                count.update(_words(t))
            if len(count) > FLUSH:
                yield flush(count)
                count = Counter()
    if count:
        yield flush(count)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of the one text column: the corpus counts, without the ends of texts."""
    return texts.mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words, numbered from 0, and totals over all training texts."""

    held: list[bytes]
    counts: np.ndarray  # of the held words
    tokens: int
    kinds: int
    documents: int

    @property
    def base_total(self) -> int:
        return self.tokens + self.kinds + 1


def vocabulary(counts: DataFrame, documents: int, held_words: int = HELD_WORDS) -> Vocabulary:
    """Ends of texts are tokens of a kind of their own. The driver gets the held words and totals."""
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(held_words).toArrow()
    held = top["word"].cast(pa.binary()).to_pylist()
    return Vocabulary(held, top["n"].to_numpy().astype(np.int64), total + documents, kinds + int(documents > 0), documents)


def _numbered(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(shared.value)}
        get, held = place.get, len(place)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            at = 0
            for _, part in slices(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()):
                rows = []
                for t in part:
                    words = _words(t)
                    ids = np.array([get(w, -1) for w in words], np.int32)
                    open_: dict[bytes, int] = {}
                    spots = np.nonzero(ids < 0)[0]
                    if len(spots):
                        ids[spots] = [held + open_.setdefault(words[i], len(open_)) for i in spots.tolist()]
                    rows.append((uid, ids.astype("<i4").tobytes(), list(open_)))
                    uid += 1
                uids, ids, words = zip(*rows, strict=True)
                words = pa.array(words, pa.list_(pa.binary())).cast(schema.types[-1])
                cols = [*(c.slice(at, len(part)) for c in kept), pa.array(uids), pa.array(ids, pa.binary()), words]
                at += len(part)
                yield pa.record_batch([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema)

    return run


def numbered(df: DataFrame, held: list[bytes], carry: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The carried columns of each row plus uid, ids and words: the text as numbers, 32 bits a word.

    A held word's number is its place; the text's other words are listed in ``words``, without repeats, and
    numbered on from the number of held words. Null texts have no words.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    source = df.select(*[c.alias(k) for k, c in carry.items()], F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = StructType(source.schema.fields[:-1] + StructType.fromDDL("uid bigint, ids binary, words array<string>").fields)
    shared = df.sparkSession.sparkContext.broadcast(held)
    return source.mapInArrow(_numbered(shared, to_arrow_schema(out)), out)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after another, and where each row's begin (one more for the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def _id_runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of consecutive texts: index of the first, their word numbers joined, and words in each."""
    _, offsets = _values(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + RUN_BYTES, "right")) - 1)
        raw, at = _values(column.slice(lo, hi - lo))
        yield lo, np.frombuffer(raw.tobytes(), "<i4"), np.diff(at) // 4
        lo = hi


def _between_ends(values: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all texts with ``end`` before, between and after texts, and where each value stands."""
    place = np.arange(len(values)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)
    out = np.full(len(values) + len(lengths) + 1, end, values.dtype)
    out[place] = values
    return out, place


@dataclass(frozen=True)
class Model:
    """Classes of the first ``len(cls) - 2`` held words; the last two are those of all other words and of the end of a
    text, which also stands before the first word."""

    words: Vocabulary
    cls: np.ndarray
    between: np.ndarray  # counts of neighbouring classes
    weight: np.ndarray  # tokens of the class words in each class


def _pair_counts(n: int):
    """Counts of neighbouring tokens over class words, other words (n) and ends (n + 1)."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + 2) ** 2, np.int64)
        for batch in batches:
            for _, ids, lengths in _id_runs(batch.column(0)):
                seq, _ = _between_ends(np.minimum(ids, n).astype(np.int64), lengths, n + 1)
                np.add.at(total, seq[:-1] * (n + 2) + seq[1:], 1)
        seen = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], schema)

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each word, given the counts of neighbouring words.

    The last two rows of ``pairs`` (other words, ends) keep classes of their own. Words start dealt out by
    frequency rank; sweeps go on until none of them moves a word. Each move raises the likelihood, so they end.
    Ties keep the lower class.
    """
    n = len(pairs) - 2
    classes = max(1, min(classes, n))
    cls = np.concatenate([np.arange(n) % classes, [classes, classes + 1]])
    k = classes + 2
    one = np.zeros((n + 2, k))
    one[np.arange(n + 2), cls] = 1
    between = one.T @ pairs @ one

    moved = 1
    while moved:
        moved = 0
        for w in range(n):
            old = cls[w]
            out = np.bincount(cls, weights=pairs[w], minlength=k)
            into = np.bincount(cls, weights=pairs[:, w], minlength=k)
            self_ = pairs[w, w]
            out[old] -= self_
            into[old] -= self_
            # Take the word out of its class, then price every class it could join.
            rest = between.copy()
            rest[old, :] -= out
            rest[:, old] -= into
            rest[old, old] -= self_
            # What stands before and after the word counts for its neighbours' classes wherever it goes.
            rows, cols = rest.sum(axis=1) + into, rest.sum(axis=0) + out
            mine_out, mine_in = out.sum() + self_, into.sum() + self_
            gain = (_xlogx(rest + out) - _xlogx(rest)).sum(axis=1) + (_xlogx(rest + into[:, None]) - _xlogx(rest)).sum(axis=0)
            d = np.diag(rest)
            gain -= _xlogx(d + out) - _xlogx(d) + _xlogx(d + into) - _xlogx(d)
            gain += _xlogx(d + out + into + self_) - _xlogx(d)
            gain -= _xlogx(rows + mine_out) - _xlogx(rows) + _xlogx(cols + mine_in) - _xlogx(cols)
            best = int(gain[:classes].argmax())
            if gain[best] <= gain[old] + 1e-6:  # rounding alone is no gain
                best = old
            moved += best != old
            rest[best, :] += out
            rest[:, best] += into
            rest[best, best] += self_
            between, cls[w] = rest, best
    return cls


def _transitions(between: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), smoothed with the class's own frequency."""
    size = between.sum(axis=0)
    share = (size + 1) / (size.sum() + len(between))
    return np.log10((between + PRIOR * share) / (between.sum(axis=1, keepdims=True) + PRIOR))


def train(ids: DataFrame, words: Vocabulary, class_words: int = CLASS_WORDS, classes: int = CLASSES) -> Model:
    """The classes of the most frequent words, from the training texts as numbers (column ``ids``).

    The driver gets the pair counts of the class words, of bounded size.
    """
    n = min(class_words, len(words.held))
    found = ids.select("ids").mapInArrow(_pair_counts(n), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros((n + 2) ** 2)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    pairs = pairs.reshape(n + 2, n + 2)
    # Texts follow one another in a task's count; each counts as standing between two ends.
    cls = exchange(pairs, classes)
    one = np.zeros((n + 2, int(cls.max()) + 1))
    one[np.arange(n + 2), cls] = 1
    weight = one[:n].T @ words.counts[:n] if n else np.zeros(one.shape[1])
    return Model(words, cls, one.T @ pairs @ one, weight)


def _neighbour_classes(shared):
    """(word, codes, times) of the words outside the core, a row for each word and task: code h counts the class h
    after the word, k + g the class g before it, and 2k the word after itself, which the other two leave out."""
    schema = pa.schema([("word", pa.string()), ("codes", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        later, held, cls = shared.value  # the held words that have no class yet
        n, k = len(cls) - 2, int(cls.max()) + 1
        width = 2 * k + 1
        later = pa.array(later, pa.binary())
        local: dict[bytes, int] = {}  # words not held, numbered on from these
        codes, times = [], []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            seen, at = np.unique(np.concatenate(codes), return_inverse=True)
            return seen, np.bincount(at, weights=np.concatenate(times)).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            seen, count = merged()
            words = pa.concat_arrays([later, pa.array(list(local), pa.binary())]).cast(pa.string())
            which, first = np.unique(seen // width, return_index=True)
            ends = np.append(first, len(seen))
            for i in range(0, len(which), FLUSH):
                part, cut = which[i : i + FLUSH], ends[i : i + FLUSH + 1]
                lo, hi = cut[0], cut[-1]
                offsets = pa.array((cut - lo).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((seen[lo:hi] % width).astype(np.int32), count[lo:hi])]
                yield pa.record_batch([words.take(pa.array(part)), *lists], schema)

        for batch in batches:
            for at, ids, lengths in _id_runs(batch.column(0)):
                ids = ids.astype(np.int64)
                listed = batch.column(1).slice(at, len(lengths))
                here = np.array([local.setdefault(w, len(local)) for w in listed.flatten().cast(pa.binary()).to_pylist()], np.int64)
                first = np.cumsum(np.append(0, listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))[:-1]
                opened = ids >= held
                where = (ids - held + np.repeat(first, lengths))[opened]
                ids[opened] = held + here[where]
                seq, place = _between_ends(ids, lengths, -1)
                around = np.where(seq < 0, cls[n + 1], cls[np.where(seq < n, seq, n)])
                spots = place[ids >= n]
                word = (seq[spots] - n) * width
                after = word + np.where(seq[spots + 1] == seq[spots], 2 * k, around[spots + 1])
                before = (word + k + around[spots - 1])[seq[spots - 1] != seq[spots]]
                seen, count = np.unique(np.concatenate([after, before]), return_counts=True)
                codes.append(seen)
                times.append(count)
                if sum(map(len, codes)) > 4 * FLUSH:
                    codes, times = ([x] for x in merged())
                if len(local) > FLUSH or sum(map(len, codes)) > 2 * FLUSH and len(codes) == 1:
                    yield from flush()
                    local, codes, times = {}, [], []
        if codes and sum(map(len, codes)):
            yield from flush()

    return run


def best_classes(out: np.ndarray, into: np.ndarray, self_: np.ndarray, between: np.ndarray) -> np.ndarray:
    """For each word in the class of other words, the class that raises the likelihood most when this word alone
    moves there, priced as in ``exchange``. Ties keep the lower class.

    ``out`` and ``into`` have a row for each word: its counts by the class after and before it.
    """
    o = len(between) - 2  # also the number of classes to choose from
    gain = np.zeros((len(out), o))
    for side, m in ((out, between), (into, between.T)):
        for h in (*range(o), o + 1):
            w = np.nonzero(side[:, h])[0]
            gain[w] += _xlogx(m[:o, h] + side[w, h, None]) - _xlogx(m[:o, h])
    # The class of other words loses the word, whichever class it joins.
    for left, mine in ((between[:o, o] - into[:, :o], out), (between[o, :o] - out[:, :o], into)):
        gain += _xlogx(left + mine[:, [o]]) - _xlogx(left)
    d, a, b = np.diag(between)[:o], out[:, :o], into[:, :o]
    gain += _xlogx(d + a + b + self_[:, None]) + _xlogx(d) - _xlogx(d + a) - _xlogx(d + b)
    for total, mine in ((between.sum(axis=1)[:o], out), (between.sum(axis=0)[:o], into)):
        gain -= _xlogx(total + (mine.sum(axis=1) + self_)[:, None]) - _xlogx(total)
    return gain.argmax(axis=1)


def _classified(shared):
    """(word, n, cls) from sorted rows of (word, codes, times): a word's rows follow one another."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("cls", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = shared.value
        k = len(between)

        def priced(words: pa.Array, count: np.ndarray) -> pa.RecordBatch:
            out, into, self_ = count[:, :k], count[:, k : 2 * k], count[:, 2 * k]
            n = (out.sum(axis=1) + self_).astype(np.int64)
            cls = best_classes(out, into, self_, between).astype(np.int32)
            return pa.record_batch([words, pa.array(n), pa.array(cls)], schema)

        last, rest = None, None  # a word whose rows may go on
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                words, codes, times = part.column(0).cast(pa.string()), part.column(1), part.column(2)
                new = np.ones(part.num_rows, bool)
                new[1:] = pc.not_equal(words.slice(1), words.slice(0, part.num_rows - 1)).to_numpy(zero_copy_only=False)
                group = np.cumsum(new) - 1
                size = int(group[-1]) + 1
                row = np.repeat(group, codes.value_lengths().to_numpy())
                flat = row * (2 * k + 1) + codes.flatten().to_numpy()
                count = np.bincount(flat, weights=times.flatten().to_numpy(), minlength=size * (2 * k + 1)).reshape(size, -1)
                firsts = words.take(pa.array(np.nonzero(new)[0]))
                if last is not None:
                    if firsts[0] == last:
                        count[0] += rest
                    else:
                        yield priced(pa.array([last.as_py()]), rest[None, :])
                last, rest = firsts[size - 1], count[size - 1]
                if size > 1:
                    yield priced(firsts.slice(0, size - 1), count[:-1])
        if last is not None:
            yield priced(pa.array([last.as_py()]), rest[None, :])

    return run


def word_classes(ids: DataFrame, core: Model) -> DataFrame:
    """(word, n, cls) of every training word that has no class in ``core``: its count and best class.

    ``ids`` are the training texts as numbers. Words are dealt out, and a task sends few rows for each word, which
    are added up one after another, so no word's rows are gathered.
    """
    spark, n = ids.sparkSession, len(core.cls) - 2
    words = spark.sparkContext.broadcast((core.words.held[n:], len(core.words.held), core.cls))
    found = ids.select("ids", "words").mapInArrow(_neighbour_classes(words), "word string, codes array<int>, times array<bigint>")
    between = spark.sparkContext.broadcast(core.between)
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(_classified(between), "word string, n bigint, cls int")


def _paths(shared, schema: pa.Schema):
    """Class paths of texts as numbers, whose words that are not held have met their counts and classes; words that
    training never saw get the class of other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, cls, weight, other, end, unseen = shared.value
        held = len(counts)
        log_count, emission = np.log10(counts + 1.0), np.log10(counts / weight[cls])
        mark = (cls + ONCE * (counts == 1)).astype(np.uint8)
        for batch in batches:
            names = batch.schema.names
            kept = [batch.column(i) for i in range(len(schema) - 4)]
            met, sizes = batch.column(names.index("met")), batch.column(names.index("open"))
            for at, ids, lengths in _id_runs(batch.column(names.index("ids"))):
                n = len(lengths)
                # The words of all texts in one list: the held ones, then each text's own.
                size = sizes.slice(at, n).to_numpy().astype(np.int64)
                first = np.cumsum(np.append(0, size))
                own = met.slice(at, n)
                text = np.repeat(np.arange(n), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                slot, times, found = (own.flatten().field(i).to_numpy() for i in range(3))
                count, c = np.zeros(first[-1], np.int64), np.full(first[-1], other)
                count[first[text] + slot], c[first[text] + slot] = times, found
                logs = np.concatenate([log_count, np.log10(count + 1.0)])
                emits = np.concatenate([emission, np.where(count > 0, np.log10(np.maximum(count, 1) / weight[c]), unseen)])
                marks = np.concatenate([mark, (c + ONCE * (count == 1)).astype(np.uint8)])
                here = np.repeat(np.arange(n), lengths)
                ids = ids + np.where(ids >= held, first[here], 0)
                known = np.bincount(here, weights=(ids < held) | (logs[ids] > 0), minlength=n).astype(np.int64)
                base, classed = (np.bincount(here, weights=x[ids], minlength=n) for x in (logs, emits))
                path, _ = _between_ends(marks[ids], lengths, end)
                cut = np.cumsum(np.append(0, lengths + 1))
                paths = [path[a : b + 1].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                cols = [*(x.slice(at, n) for x in kept), pa.array(known), pa.array(base), pa.array(classed), pa.array(paths, pa.binary())]
                yield pa.record_batch([x.cast(f.type) for x, f in zip(cols, schema, strict=True)], schema)

    return run


def _class_pairs(k: int, other: int):
    """Counts of neighbouring classes, and from k * k on those that words seen once add for unseen ones: each is
    what an unseen word would be if its text were left out."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * k * k, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                path = np.frombuffer(raw, np.uint8).astype(np.int64)
                once, cls = path >= ONCE, path % ONCE
                total[: k * k] += np.bincount(cls[:-1] * k + cls[1:], minlength=k * k)
                if once.any():
                    unseen = np.where(once, other, cls)
                    some = once[:-1] | once[1:]
                    total[k * k :] += np.bincount((unseen[:-1] * k + unseen[1:])[some], minlength=k * k)
        seen = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], schema)

    return run


def _followed(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition = shared.value
        for batch in batches:
            paths = [np.frombuffer(raw, np.uint8) % ONCE for raw in batch.column(batch.num_columns - 1).to_pylist()]
            scores = pa.array([float(transition[p[:-1], p[1:]].sum()) for p in paths], pa.float64())
            lengths = pa.array([len(p) - 1 for p in paths], pa.int64())
            cols = [*batch.columns[:-1], lengths, scores]
            yield pa.record_batch([x.cast(t) for x, t in zip(cols, schema.types, strict=True)], schema)

    return run


def score_all_words(df: DataFrame, training: Column, carry: dict[str, Column], text_col: str = "text",
                    class_words: int = CLASS_WORDS, classes: int = CLASSES, held_words: int = HELD_WORDS) -> DataFrame:
    """The carried columns of each row plus n_tokens, n_known, train_tokens, base_score, score and perplexity, by a
    model of the rows for which ``training`` holds, with every training word in a class.

    ``base_score`` is the add-one unigram score, ``score`` that of the class bigrams, both log10 of the whole
    text with its end. A null text counts as empty: one token. Repeated rows are scored alike, and each counts in
    training; none is dropped. With nothing to train on every word is unseen. A null ``training`` is false.

    The driver gets the held words with their classes, pair counts of class words, and totals.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark, c = df.sparkSession, F.col
    training = F.coalesce(training, F.lit(False))
    learnt = df.filter(training).select(F.coalesce(c(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    counts = landed(word_counts(learnt), "words")
    words = vocabulary(counts, learnt.count(), held_words)
    fixed = {f"c{i}": v for i, v in enumerate(carry.values())}
    parts = landed(numbered(df, words.held, fixed | {"training": training}, text_col), "numbered")
    ids = parts.filter("training")
    core = train(ids, words, class_words, classes)
    n, other, end = len(core.cls) - 2, int(core.cls[-2]), int(core.cls[-1])
    k = end + 1
    if k >= ONCE:
        raise ValueError("a path has room for 127 classes")
    rest = landed(word_classes(ids, core), "word-classes")

    weight, once = core.weight.copy(), int((words.counts[:n] == 1).sum())
    for r in rest.groupBy("cls").agg(F.sum("n").alias("n"), F.count_if(c("n") == 1).alias("once")).collect():
        weight[r.cls] += r.n
        once += r.once
    weight = np.maximum(weight, 1)
    cls = np.append(core.cls[:n], np.zeros(len(words.held) - n, core.cls.dtype))
    if len(words.held) > n:
        last, least = words.held[-1].decode(), int(words.counts[-1])
        top = rest.filter((c("n") > least) | ((c("n") == least) & (c("word") <= F.lit(last)))).toArrow()
        place = {w: i for i, w in enumerate(words.held)}
        cls[[place[w] for w in top["word"].cast(pa.binary()).to_pylist()]] = top["cls"].to_numpy()

    met = parts.select("uid", F.posexplode("words").alias("slot", "word")).join(rest, "word").groupBy("uid").agg(
        F.collect_list(F.struct("slot", "n", "cls")).alias("met")
    )
    joined = parts.select(*fixed, "training", "uid", "ids", F.size("words").alias("open")).join(met, "uid", "left")
    joined = joined.select(*fixed, "training", "ids", "open", "met")
    paths_type = StructType(joined.schema.fields[:-3] + StructType.fromDDL("known bigint, base double, classed double, path binary").fields)
    # An unseen word is taken for one of as many as were seen once.
    shared = spark.sparkContext.broadcast((words.counts, cls, weight, other, end, -np.log10(once + 1)))
    paths = landed(joined.mapInArrow(_paths(shared, to_arrow_schema(paths_type)), paths_type), "paths")

    found = paths.filter("training").select("path").mapInArrow(_class_pairs(k, other), "pair bigint, n bigint")
    found = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(2 * k * k)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    transition = spark.sparkContext.broadcast(_transitions(pairs.reshape(2, k, k).sum(axis=0)))
    scored_type = StructType(paths_type.fields[:-1] + StructType.fromDDL("n_tokens bigint, followed double").fields)
    scored = paths.mapInArrow(_followed(transition, to_arrow_schema(scored_type)), scored_type)
    base = c("base") + float(np.log10(words.documents + 1.0)) - c("n_tokens") * float(np.log10(words.base_total))
    whole = c("classed") + c("followed")
    return scored.select(
        *[c(x).alias(k) for x, k in zip(fixed, carry, strict=True)], "n_tokens",
        (c("known") + int(words.documents > 0)).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        whole.alias("score"), F.pow(F.lit(10.0), -whole / c("n_tokens")).alias("perplexity"),
    )


def held_out(id_col: str = "doc_id") -> Column:
    return bucket(F.col(id_col), 7) == 2


def op10_brown_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by a model of those not held out; see :func:`score_all_words`."""
    docs = table(spark, sf_dir, "documents")
    return score_all_words(docs, ~held_out(), {"doc_id": F.col("doc_id"), "held_out": held_out()})
