"""Language-model scores of documents, by causal self-attention over subword ids.

A text is its words (A-Z lower-cased, split at white space), each with one space before it,
encoded by a public byte-level vocabulary, then one end.  The model gives every id

    P(class of id | the ids before it, by attention) x P(id | its class, the id before it)

* The first factor is a self-attention network in numpy (``attention.py``).  Documents are
  cut into windows of ``width`` ids that overlap; each id is scored once, the ids of a
  document's first window from what there is before them, all others from
  ``width - stride`` ids at least, under a causal mask, many windows at a time.
* The second factor is counted over all training documents, the id before it by its
  frequency class (frequent ids have one of their own), and smoothed with the id's share of
  its class, so no id has probability zero.
* Classes are clusters of ids by what stands before them in the corpus.  All but the
  ``common`` most frequent ids share one class and, in both factors, one column; an id's
  share of it is its share of their count.

Both factors sum to one, so scores are logarithms of probabilities of id sequences.

Counts and the network's weights come from every training document.  The weights begin as
those of a bounded draw (``fit_windows`` windows at most, the lowest hashes among all), and
then every predicted id of every training document is learned from, once: each task goes on
from the first weights over the windows of its own documents, and the weights of all tasks are
averaged, by windows (parallel stochastic gradient descent).  What a task holds of them is bounded by the model's size: ``before`` times
``common`` numbers of four bytes (17 MB).

The base score is that of a unigram model of the words, counted over all training
documents.  Words are counted by their 64-bit digests (of d different words, d^2 / 2^65 are
expected to share one).  The ``frequent`` words of most documents, a bounded list, are looked
up in the tasks, so that a word in every document makes no hot group; all others meet their
counts by a join.

Training documents are those whose crc32(doc_id as text) mod 5 is not 1.  Defined results:
null text counts as empty and has one token, its end; a null doc_id counts as the empty
string and its rows are training rows; repeated rows each count and each get a row; without
any training document all counts are zero and the network keeps its first weights; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.attention import Adam, Attention, batches, window_starts
from candela.llm.common import stored, text_of
from candela.llm.tokens import SPECIAL_ID, tokens_of

#: Ids of the vocabulary, the end among them.
END, IDS = SPECIAL_ID, SPECIAL_ID + 1
FREQUENT = 400_000
#: First bits of a digest by which it is looked up among the frequent ones.
HEAD = 20
CLASSES, BEFORE, COMMON, SIZE, WIDTH, STRIDE = 64, 1024, 4096, 16, 32, 28
FIT_WINDOWS, EPOCHS = 16_384, 6
#: The pass over all training windows: windows a step, and the rate, which falls with the steps of a task.
BATCH, RATE = 256, 0.002
#: Weights travel as whole numbers of this size, so that their sums do not depend on the order.
UNIT = 2.0 ** -24
#: Weight of an id's share of its class among the counts behind one id.
PRIOR = 6.0


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def words_of(text: str) -> list[bytes]:
    """The UTF-8 words of a text: bytes.lower() takes A-Z alone, bytes.split() parts at the six ASCII spaces."""
    return text.encode().lower().split()


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """One stored row per document: its ids (unsigned 16-bit), and its words' digests and counts (64 and 32-bit)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    names = ["row", "doc_id", "held_out", "n_words", "ids", "words", "counts"]

    def encode(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokens_of(path).bpe
        for batch in texts:
            start = 0
            while start < batch.num_rows:  # small pieces, or one long text
                n_words, ids, digests, counts, at, size = [], [], [], [], start, 0
                while at < batch.num_rows and size < 200_000:
                    words = words_of(batch.column("text")[at].as_py())
                    text = (b" " + b" ".join(words)).decode() if words else ""
                    ids.append(np.append(bpe.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), END).astype("<u2").tobytes())
                    own, n = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), return_counts=True)
                    digests.append(own.tobytes())
                    counts.append(n.astype("<u4").tobytes())
                    n_words.append(len(words))
                    size += len(words)
                    at += 1
                own = batch.slice(start, at - start)
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), own.column("held_out"), pa.array(n_words, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(digests, pa.binary()), pa.array(counts, pa.binary())], names=names)
                start = at

    return stored(rows.mapInArrow(encode, "row long, doc_id long, held_out boolean, n_words long, ids binary, words binary, counts binary"),
                  "encoded")


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Rows of a batch in groups of some 200,000 ids: (first row, rows, ids behind an end each)."""
    held, size, start = [], 0, 0
    for i, raw in enumerate(batch.column("ids")):
        held.append(np.frombuffer(END.to_bytes(2, "little") + raw.as_py(), "<u2"))
        size += len(held[-1])
        if size >= 200_000:
            yield start, len(held), held
            held, size, start = [], 0, i + 1
    if held:
        yield start, len(held), held


def _flat(seqs: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids (with room for a window behind the last), and by sequence its predicted ids and where it begins."""
    flat = np.concatenate([*seqs, np.full(width + 1, END, "<u2")])
    return flat, np.array([len(s) - 1 for s in seqs]), np.cumsum([0, *(len(s) for s in seqs)])[:-1]


def _windows(seqs: list[np.ndarray], width: int, stride: int) -> tuple[np.ndarray, ...]:
    """All ids; by window: places of its ids, which places are scored, sequence."""
    flat, lengths, offsets = _flat(seqs, width)
    seq, start, first = window_starts(lengths, width, stride)
    place = np.arange(width)
    scored = (place >= first[:, None]) & (start[:, None] + place < lengths[seq][:, None])
    return flat, (offsets[seq] + start)[:, None] + place, scored, seq


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number of each."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_windows(train: DataFrame, width: int, stride: int, most: int) -> np.ndarray:
    """(windows, width + 2) ids of the windows with the lowest hashes, and which targets are a document's own."""
    total = train.select(F.sum(F.lit(1) + F.octet_length("ids") / (2 * stride))).first()[0] or 0
    # A first cut well above what is kept: the rows that travel are few, the lowest hashes are among them.
    limit = int(min(1.0, 4 * most / max(total, 1)) * (2**63 - 1))

    def draw(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names = batch.column("doc_id").to_pylist()
            for start, n, seqs in _sequences(batch):
                flat, lengths, offsets = _flat(seqs, width)
                seq, at, _ = window_starts(lengths, width, stride)
                seeds = np.array([crc32(str(names[start + i]).encode()) << 32 | crc32(seqs[i].tobytes()) for i in range(n)], np.uint64)
                h = (_mixed(seeds[seq] + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)).astype(np.int64)
                own = np.flatnonzero(h <= limit)
                place = np.arange(width + 1)
                left = np.minimum(width, lengths[seq[own]] - at[own])
                ids = flat[(offsets[seq[own]] + at[own])[:, None] + place]
                ids[place > left[:, None]] = END
                yield pa.RecordBatch.from_pydict({"h": pa.array(h[own]), "n": pa.array(left.astype(np.int32), pa.int32()),
                                                  "ids": pa.array([r.tobytes() for r in ids], pa.binary())})

    found = (train.select("doc_id", "ids").mapInArrow(draw, "h long, n int, ids binary")
             .orderBy("h", "ids").limit(most).collect())
    ids = np.array([np.frombuffer(r["ids"], "<u2") for r in found], np.int32).reshape(-1, width + 1)
    return np.c_[ids, np.array([r["n"] for r in found], np.int32).reshape(-1, 1)]


def id_counts(train: DataFrame) -> np.ndarray:
    """How often each id of the vocabulary stands in the training documents."""
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in rows:
            for _, _, seqs in _sequences(batch):
                total += np.bincount(np.concatenate([s[1:] for s in seqs]), minlength=IDS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    found = train.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(IDS, np.int64)
    for r in found.collect():  # one row an id of the vocabulary at most
        counts[r["id"]] = r["n"]
    return counts


def frequency_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """The class of every id: ids by falling count, cut so that classes have like shares."""
    mass = counts + 0.5
    order = np.argsort(-counts, kind="stable")
    out = np.zeros(len(counts), np.int32)
    now, got, left = 0, 0.0, mass.sum()
    for i in order:
        out[i] = now
        got += mass[i]
        if now < classes - 1 and got >= left / (classes - now):
            now, left, got = now + 1, left - got, 0.0
    return out


def counts_behind(train: DataFrame, before: np.ndarray, column: np.ndarray) -> np.ndarray:
    """By frequency class and column: how often an id of the column follows one of the class (float32)."""
    lines, width = int(before.max()) + 1, int(column.max()) + 1
    shared = train.sparkSession.sparkContext.broadcast((before, column))  # two numbers an id

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, column = shared.value
        total = np.zeros(lines * width, np.int32)
        for batch in rows:
            for _, _, seqs in _sequences(batch):
                np.add.at(total, np.concatenate([before[s[:-1]] * width + column[s[1:]] for s in seqs]), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": pa.array((seen // width).astype(np.int32)),
                                          "at": pa.array((seen % width).astype(np.int32)), "n": pa.array(total[seen].astype(np.int64))})

    def line(group: pa.Table) -> pa.Table:  # one row a column at most
        counts = np.zeros(width, "<f4")
        counts[group.column("at").to_numpy()] = group.column("n").to_numpy()
        return pa.table({"c": pa.array([group.column("c")[0].as_py()], pa.int32()), "line": pa.array([counts.tobytes()], pa.binary())})

    summed = (train.select("ids").mapInArrow(count, "c int, at int, n long").groupBy("c", "at").agg(F.sum("n").alias("n"))
              .groupBy("c").applyInArrow(line, "c int, line binary"))
    out = np.zeros((lines, width), np.float32)
    for r in summed.toLocalIterator():  # as many rows as classes
        out[r["c"]] = np.frombuffer(r["line"], "<f4")
    return out


def clusters(behind: np.ndarray, counts: np.ndarray, n: int, dims: int = 24, rounds: int = 12) -> np.ndarray:
    """Clusters (0 to ``n`` - 1) of ids by the classes they follow: ``behind`` has a column for each, ``counts`` its sum.

    Weighted k-means, begun from the most frequent ids, in the main directions of the square
    roots of each id's shares.
    """
    kept = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int32)
    if not len(kept):
        return out
    weight = np.sqrt(counts[kept].astype(np.float64))
    shares = np.sqrt(behind[:, kept].T / counts[kept, None]).astype(np.float64)
    shares -= (counts[kept] / counts[kept].sum()) @ shares
    scaled = shares * np.sqrt(weight)[:, None]
    _, directions = np.linalg.eigh(scaled.T @ scaled)
    x = shares @ directions[:, -dims:]
    middle = x[np.argsort(-counts[kept], kind="stable")[:n]].copy()
    for _ in range(rounds):
        own = ((middle ** 2).sum(1) - 2 * x @ middle.T).argmin(1)
        size = np.bincount(own, weights=weight, minlength=len(middle))
        for j in range(x.shape[1]):
            sums = np.bincount(own, weights=weight * x[:, j], minlength=len(middle))
            middle[:, j] = np.where(size > 0, sums / np.maximum(size, 1e-9), middle[:, j])
    out[kept] = own
    return out


def trained_on_all(train: DataFrame, net: Attention, column: np.ndarray, classes: np.ndarray, width: int,
                   batch: int = BATCH, rate: float = RATE) -> int:
    """Train ``net`` on every window of the training documents, each once; returns their number.

    Windows do not overlap here, so every predicted id is in one.  A task sends its weights
    (bounded by the vocabulary) times its windows; the sums by place are one row a weight.
    """
    shared = train.sparkSession.sparkContext.broadcast((net, column, classes))
    names = sorted(net.p)

    def learn(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, column, classes = shared.value
        own = Attention(*first.shape)
        own.p = {k: v.copy() for k, v in first.p.items()}
        adam, rng, windows = Adam(own), np.random.default_rng(5), 0
        for rows_ in rows:
            for _, _, seqs in _sequences(rows_):
                flat, lengths, offsets = _flat(seqs, width)
                seq, at, _ = window_starts(lengths, width, width)
                order = rng.permutation(len(seq))
                place = np.arange(width)
                for i in range(0, len(order), batch):
                    some = order[i:i + batch]
                    where = (offsets[seq[some]] + at[some])[:, None] + place
                    valid = place < (lengths[seq[some]] - at[some])[:, None]
                    ids = column[np.where(valid, flat[where], END)]
                    targets = classes[column[flat[where + 1]]]
                    now = rate * min(1.0, (adam.steps + 1) / 50) / max(1.0, adam.steps / 200) ** 0.5
                    adam.step(ids, targets, valid, now)
                windows += len(order)
        if windows:
            weights = np.concatenate([own.p[k].reshape(-1) for k in names]).astype(np.float64)
            sums = np.append(np.rint(weights / UNIT).astype(np.int64) * windows, windows)
            yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(sums), dtype=np.int32)), "n": pa.array(sums)})

    found = (train.select("ids").mapInArrow(learn, "place int, n long")
             .groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")))
    sums = {r["place"]: int(r["n"]) for r in found.collect()}  # one row a weight
    if not sums:
        return 0
    windows = sums[len(sums) - 1]
    weights, at = np.array([sums[i] / windows for i in range(len(sums) - 1)]) * UNIT, 0
    for k in names:
        net.p[k] = weights[at:at + net.p[k].size].reshape(net.p[k].shape).astype(np.float32)
        at += net.p[k].size
    return windows


@dataclass
class LanguageModel:
    """Common ids have a column each; the last column, in a class of its own, is for all others."""

    net: Attention           # over columns
    column: np.ndarray       # by id
    before: np.ndarray       # by id: its frequency class
    classes: np.ndarray      # by column
    share: np.ndarray        # by column: its smoothed share of its class
    within: np.ndarray       # by id: its smoothed share of its column
    behind: np.ndarray       # counts by (frequency class before, column)
    totals: np.ndarray       # their sums by (frequency class before, class)
    width: int
    stride: int
    prior: np.float32

    def inside(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(id | its class, frequency class of the id before)."""
        k, at = self.before[before], self.column[ids]
        n = self.behind.reshape(-1)[k * self.behind.shape[1] + at]
        total = self.totals.reshape(-1)[k * self.totals.shape[1] + self.classes[at]]
        return np.log((n + self.prior * self.share[at]) / (total + self.prior) * self.within[ids])

    def score(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Logarithm (base 10) of the probability of each sequence of ids behind its first one."""
        flat, at, scored, seq = _windows(seqs, self.width, self.stride)
        columns = self.column[flat]
        rows, places = np.nonzero(scored)
        where, found = at[rows, places], np.empty(len(rows))
        targets, ends = self.classes[columns[where + 1]], np.cumsum(np.r_[0, scored.sum(1)])
        for some in batches(at):
            own = slice(ends[some.start], ends[min(some.stop, len(at))])
            found[own] = self.net.log_probabilities(columns[at[some]], rows[own] - some.start, places[own], targets[own])
        found += self.inside(flat[where], flat[where + 1])
        out = np.bincount(seq[rows], weights=found, minlength=len(seqs))
        return out / np.log(10)


def fit_language_model(train: DataFrame, classes: int = CLASSES, before: int = BEFORE, common: int = COMMON, size: int = SIZE,
                       width: int = WIDTH, stride: int = STRIDE, fit_windows: int = FIT_WINDOWS, epochs: int = EPOCHS,
                       prior: float = PRIOR) -> LanguageModel:
    """Count the training documents (rows of ``encoded``) and train the network on all of their windows."""
    counts = id_counts(train)
    kind = frequency_classes(counts, before)
    most = np.argsort(-counts, kind="stable")[:common]
    column = np.full(IDS, common, np.int32)
    column[most] = np.arange(common)
    behind = counts_behind(train, kind, column)
    own = np.append(clusters(behind[:, :-1], counts[most], classes - 1), np.int32(classes - 1))
    totals = np.stack([np.bincount(own, weights=line, minlength=classes) for line in behind]).astype(np.float32)
    mass = np.bincount(column, weights=counts + 0.5)
    of_class = np.bincount(own, weights=mass, minlength=classes)
    net = Attention(common + 1, classes, size, width)
    net.p["c0"][:] = np.log((of_class + 1e-9) / of_class.sum())
    drawn = drawn_windows(train, width, stride, fit_windows)
    ids, n = column[drawn[:, :-1]], drawn[:, -1:]
    net.fit(ids[:, :width], own[ids[:, 1:]], np.arange(width) < n, epochs)
    trained_on_all(train, net, column, own, width)
    return LanguageModel(net, column, kind, own, (mass / of_class[own]).astype(np.float32), ((counts + 0.5) / mass[column]).astype(np.float32),
                         behind, totals, width, stride, np.float32(prior))


@dataclass
class Unigrams:
    """Training counts of words: totals, and the counts of the frequent ones by digest."""

    tokens: int
    different: int
    ends: int
    digests: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        lowest = np.arange(-(1 << (HEAD - 1)), 1 << (HEAD - 1), dtype=np.int64) << (64 - HEAD)
        self.first = np.searchsorted(self.digests, lowest).astype(np.int32)  # by the digest's first bits

    def place(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each digest stands among the frequent ones, and whether it does."""
        last = len(self.digests) - 1
        if last < 0:
            return np.zeros(len(digests), np.int64), np.zeros(len(digests), bool)
        at = np.minimum(self.first[(digests >> (64 - HEAD)) + (1 << (HEAD - 1))], last)
        left = np.flatnonzero(self.digests[at] < digests)
        for _ in range(4):  # digests are spread evenly: few share their first bits
            at[left] = np.minimum(at[left] + 1, last)
            left = left[self.digests[at[left]] < digests[left]]
        at[left] = np.minimum(np.searchsorted(self.digests, digests[left]), last)
        return at, self.digests[at] == digests


def _slices(batches_: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for batch in batches_ for i in range(0, batch.num_rows, rows))


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the row, digest, count) of all words of a batch."""
    digests, counts = batch.column("words").to_pylist(), batch.column("counts").to_pylist()
    sizes = [len(d) // 8 for d in digests]
    return (np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(b"".join(digests), "<u8").view(np.int64),
            np.frombuffer(b"".join(counts), "<u4").astype(np.int64))


def word_counts(rows: DataFrame) -> DataFrame:
    """(w, c, docs) of every word's digest: its training count and its documents; stored."""
    def count(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            w, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            c, docs = (np.bincount(at, weights=np.concatenate([x[i] for x in held]), minlength=len(w)).astype(np.int64) for i in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array(c), pa.array(docs)], names=["w", "c", "docs"])

        for batch in _slices(batches_):
            row, w, k = _words(batch)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            held.append((w, k * train[row], np.ones(len(w), np.int8)))
            size += len(w)
            if size >= 1_000_000:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()

    found = rows.select("held_out", "words", "counts").mapInArrow(count, "w long, c long, docs long")
    return stored(found.groupBy("w").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs")), "word-counts")


def unigrams(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> Unigrams:
    sums = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    ends = rows.filter("not held_out").count()
    hot = counts.orderBy(F.desc("docs"), "w").limit(frequent).select("w", "c").toArrow()  # bounded, 16 bytes each
    digests, c = hot.column("w").to_numpy(), hot.column("c").to_numpy()
    order = np.argsort(digests)
    return Unigrams((sums["n"] or 0) + ends, (sums["v"] or 0) + (ends > 0), ends, digests[order], c[order])


def scored(rows: DataFrame, model: LanguageModel, known: Unigrams) -> DataFrame:
    """Per row of ``encoded``: ``score`` of the model, and the frequent words' part of the base score."""
    shared = rows.sparkSession.sparkContext.broadcast((model, known))  # bounded by the vocabulary and ``frequent``
    names = ["row", "doc_id", "held_out", "n_words"]

    def score(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        logs = np.log10(known.counts + 0.5)
        for batch in _slices(batches_):
            found = [model.score(seqs) for _, _, seqs in _sequences(batch)]
            row, w, k = _words(batch)
            at, hit = known.place(w)
            row, k, at = row[hit], k[hit], at[hit]
            sums = [np.bincount(row, weights=x, minlength=batch.num_rows) for x in (k * (known.counts[at] > 0), k * logs[at])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.float64)),
                 pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())], names=[*names, "hot_known", "hot_logs", "score"])

    return rows.select(*names, "ids", "words", "counts").mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_words long, hot_known long, hot_logs double, score double")


def other_words(rows: DataFrame, counts: DataFrame, known: Unigrams) -> DataFrame:
    """(row, n_known, logs): the part of the base score of the words that are not frequent."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def rest(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches_):
            row, w, k = _words(batch)
            other = ~shared.value.place(w)[1]
            own = batch.column("row").to_numpy()[row[other]]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(w[other]), pa.array(k[other].astype(np.int32))], names=["row", "w", "k"])

    k, c = F.col("k"), F.col("c")
    return (rows.select("row", "words", "counts").mapInArrow(rest, "row long, w long, k int").join(counts.select("w", "c"), "w")
            .groupBy("row").agg(F.sum(F.when(c > 0, k).otherwise(0)).alias("n_known"), F.sum(k * F.log10(c + F.lit(0.5))).alias("logs")))


def lm_scores(docs: DataFrame, path: str | None = None, frequent: int = FREQUENT, **parameters) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = encoded(docs.select("doc_id", "text"), path or vocabulary_path())
    model = fit_language_model(rows.filter("not held_out"), **parameters)
    counts = word_counts(rows)
    known = unigrams(rows, counts, frequent)
    zero, n_tokens = F.lit(0), F.col("n_words") + 1
    end = float(np.log10(known.ends + 0.5))
    norm = float(np.log10(known.tokens + 0.5 * (known.different + 1)))
    return scored(rows, model, known).join(other_words(rows, counts, known), "row", "left").select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("hot_known") + F.coalesce("n_known", zero) + int(known.ends > 0)).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("hot_logs") + F.coalesce("logs", F.lit(0.0)) + F.lit(end) - n_tokens * F.lit(norm)).alias("base_score"), "score")
