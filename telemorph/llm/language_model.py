"""Language-model scores from a log-frequency Bloom filter.

An n-gram seen c times is put into one Bloom filter once for every level from 0
to floor(log2 c). Asking for rising levels until a probe fails gives its count
up to the quantisation back; errors are one-sided. Tokens score by a bigram
model with a Dirichlet prior that backs off to add-one unigrams:

    p(w | v) = (low(v w) + m * p(w)) / (high(v) + m),   p(w) = (low(w) + 1) / (N + V + 1)

low and high are the ends of the quantised range, so the probabilities of all w
after v sum to at most 1 but for false positives.

Counting: every task counts the hashed n-grams of its batch and packs them by
hash range; one task per range adds them up and sets the bits of its own slice
of the filter. The task knows how many entries its slice holds. While a share of
``bits`` leaves ``LEAST_ROOM`` bits for each, the slices go to the driver and are
broadcast. Beyond that they get ``ROOM`` bits for each and stay a table, so the
rate of false positives is bounded whatever the corpus: the
texts' distinct n-grams are packed by hash range too, stream past the slice of
their range, and the levels found come back to the texts.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemorph.llm.hashing import U, combine, mix, token_hashes
from telemorph.llm.shared import in_fold, outside_fold, stage, text_pieces

# The hashes of the end and of the start of a text, and the two kinds of n-gram.
END, START = U(0x1234567), U(0x7654321)
WORD, PAIR = U(0xA5A5A5A5A5A5A5A5), U(0x5A5A5A5A5A5A5A5A)
#: Bits tested in the one 64-bit word that an entry belongs to.
PROBES = 4
#: Hash ranges the n-grams are dealt to; each owns a slice of the filter.
RANGES = 256
MAX_LEVELS = 64
#: Bits for each entry that a slice of the broadcast filter must have, and that longer slices get. By arithmetic
#: an n-gram never seen passes one level with probability 0.024 or 0.002, a little more as an entry has one word.
LEAST_ROOM, ROOM = 8, 16
#: Bytes of text that are Python strings at once, and tokens counted together.
SLICE, TOGETHER = 1 << 20, 1 << 21


def entry(gram: np.ndarray, level: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word and bit mask of (n-gram, level). The high hash bits choose the
    slice, so all levels of an n-gram lie in its own range's slice."""
    spread = mix(gram + U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    per_range = words // RANGES
    word = (gram >> U(64 - 8)) * U(per_range) + (spread >> U(32)) % U(per_range)
    mask = np.zeros(len(gram), U)
    for i in range(PROBES):
        mask |= U(1) << ((spread >> U(6 * i)) & U(63))
    return word.astype(np.int64), mask


def levels(filter_words: np.ndarray, gram: np.ndarray, part: int | None = None) -> np.ndarray:
    """How many levels of each n-gram are found: 0 for one never seen, else 1 + floor(log2 count) at least.
    ``filter_words`` are the whole filter, or the slice of the range ``part``, to which all n-grams belong."""
    words, first = (len(filter_words), 0) if part is None else (len(filter_words) * RANGES, len(filter_words) * part)
    found = np.zeros(len(gram), np.int64)
    active = np.arange(len(gram))
    for level in range(MAX_LEVELS):
        word, mask = entry(gram[active], level, words)
        active = active[(filter_words[word - first] & mask) == mask]
        if not len(active):
            break
        found[active] = level + 1
    return found


def low(found: np.ndarray) -> np.ndarray:
    return np.where(found > 0, np.ldexp(1.0, np.maximum(found - 1, 0)), 0.0)


def high(found: np.ndarray) -> np.ndarray:
    return np.where(found > 0, np.ldexp(1.0, found) - 1, 0.0)


def sequences(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with one end after each, and the offsets."""
    hashes, offsets = token_hashes(texts)
    out = np.insert(hashes, offsets[1:], END) if len(offsets) > 1 else hashes
    return out, offsets + np.arange(len(offsets))


def bigrams(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it in its text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1][offsets[:-1] < len(tokens)]] = START
    return before


def pieces(batches: Iterator[pd.DataFrame], size: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """Batches of some ``size`` characters, whatever the number of rows."""
    for batch in batches:
        ends = batch["text"].str.len().fillna(0).cumsum().to_numpy()
        for _, part in batch.groupby(ends // size, sort=False):
            yield part.reset_index(drop=True)


def packed_counts(kind: str, grams: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The counted n-grams of some arrays, a row for each hash range. The arrays
    leave ``grams``, and one copy is sorted in place, so little more is held."""
    held = np.concatenate(grams)
    grams.clear()
    held.sort()
    first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    counts, held = np.diff(np.r_[first, len(held)]), held[first]
    bounds = np.searchsorted(held >> U(56), np.arange(RANGES + 1, dtype=U))
    rows = []
    for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            many = counts[a:b]
            kept = np.uint16 if many.max() < 1 << 16 else np.uint32
            rows.append((part, kind, held[a:b].tobytes(), many.astype(kept).tobytes()))
    types = [pa.int32(), pa.string(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(list(column), t) for column, t in zip(zip(*rows, strict=True), types, strict=True)], ["part", "kind", "grams", "counts"])


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are hashed slice by slice; only the n-grams of ``TOGETHER`` tokens or
    a little more are held to be counted."""
    held: dict[str, list[np.ndarray]] = {"w": [], "p": []}
    size = 0
    for batch in text_pieces(batches, SLICE):
        tokens, offsets = sequences(batch.column("text").to_pylist())
        held["w"].append(mix(tokens ^ WORD))
        held["p"].append(combine(bigrams(tokens, offsets), tokens) ^ PAIR)
        size += len(tokens)
        if size >= TOGETHER:
            for kind, grams in held.items():
                yield from packed_counts(kind, grams)
            size = 0
    if size:
        for kind, grams in held.items():
            yield from packed_counts(kind, grams)


def _unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of some packed rows with their added counts."""
    if not len(rows):
        return np.zeros(0, U), np.zeros(0, np.int64)
    grams = [np.frombuffer(x, U) for x in rows["grams"]]
    counts = [np.frombuffer(c, np.uint16 if len(c) == 2 * len(g) else np.uint32) for g, c in zip(grams, rows["counts"], strict=True)]
    grams, counts = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    return grams[first], np.add.reduceat(counts.astype(np.int64), first)


def build_range(words: int):
    """A function that adds up one range: its slice of the filter, and its exact
    unigram counts packed with a histogram of them. The slice is a share of
    ``words``, or as long as its entries need if that is too little."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        unigrams = _unpack(rows[rows["kind"] == "w"])
        counted = [(grams, np.frexp(counts.astype(float))[1] - 1) for grams, counts in (unigrams, _unpack(rows[rows["kind"] == "p"]))]
        entries = sum(int((top + 1).sum()) for _, top in counted)
        share = words // RANGES
        piece = np.zeros(share if entries * LEAST_ROOM <= share * 64 else -(-entries * ROOM // 64), U)
        for grams, top in counted:
            for level in range(int(top.max()) + 1 if len(top) else 0):
                word, mask = entry(grams[top >= level], level, len(piece) * RANGES)
                np.bitwise_or.at(piece, word - part * len(piece), mask)
        grams, counts = unigrams
        table = np.bincount(np.frexp(counts.astype(float))[1], minlength=MAX_LEVELS).tolist()
        return pd.DataFrame([(part, zlib.compress(piece.tobytes(), 1), len(piece), grams.tobytes(), counts.tobytes(), int(counts.sum()), len(grams), table)], columns=["part", "slice", "size", "grams", "counts", "n", "v", "table"])

    return build


COUNTED = "part int, slice binary, size long, grams binary, counts binary, n long, v long, table array<long>"


def unigram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            yield pd.DataFrame({"gram": np.frombuffer(row.grams, np.int64), "c": np.frombuffer(row.counts, np.int64)})


def asked(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All n-grams whose levels the scores of these texts need, distinct and in order."""
    before = bigrams(tokens, offsets)
    lead = np.where(before == START, END, before)
    return np.unique(np.concatenate([mix(tokens ^ WORD), mix(lead ^ WORD), combine(before, tokens) ^ PAIR]))


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in chunks, a row each."""
    for batch in text_pieces(batches, SLICE):
        whole = pa.array([0, batch.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(whole, batch.column(c)) for c in ("doc_id", "key", "text")]
        yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *lists], ["chunk", "doc_ids", "keys", "texts"])


def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The n-grams every chunk asks for, packed by hash range."""
    for batch in batches:
        for row in batch.itertuples():
            grams = asked(*sequences(list(row.texts)))
            bounds = np.searchsorted(grams >> U(56), np.arange(RANGES + 1, dtype=U))
            rows = [(part, row.chunk, grams[a:b].tobytes()) for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            yield pd.DataFrame(rows, columns=["part", "chunk", "body"])


def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Levels of the n-grams asked for. In every range the slice, which has no
    chunk, comes first; only one slice is held at a time."""
    held, piece = -1, np.zeros(0, U)
    for batch in batches:
        rows = []
        for row in batch.itertuples():
            if row.chunk == "":
                held, piece = row.part, np.frombuffer(zlib.decompress(row.body), U)
                continue
            grams = np.frombuffer(row.body, U)
            found = levels(piece, grams, row.part) if row.part == held else np.zeros(len(grams), np.int64)
            rows.append((row.chunk, row.part, found.astype(np.uint8).tobytes()))
        yield pd.DataFrame(rows, columns=["chunk", "part", "found"])


def answered(texts: DataFrame, counted: DataFrame) -> DataFrame:
    """Chunks of ``texts`` (doc_id, key, text) with the levels of their n-grams
    as the slices in ``counted`` have them, in parts by hash range. Slices and
    questions meet by range in sorted streams, so neither is gathered."""
    chunks = stage(texts.select(F.col("doc_id").cast("string").alias("doc_id"), "key", "text").mapInArrow(gather, "chunk string, doc_ids array<string>, keys array<string>, texts array<string>"))
    questions = chunks.select("chunk", "texts").mapInPandas(ask, "part int, chunk string, body binary")
    slices = counted.select("part", F.lit("").alias("chunk"), F.col("slice").alias("body"))
    met = slices.unionByName(questions).repartition(RANGES, "part").sortWithinPartitions("part", "chunk")
    found = met.mapInPandas(answer, "chunk string, part int, found binary")
    return chunks.join(found.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "found"))).alias("found")), "chunk")


def score(
    docs: DataFrame,
    train: DataFrame,
    bits: int = 1 << 29,
    prior: float = 200.0,
    head: int = 1 << 20,
) -> DataFrame:
    """Scores of all whole texts of ``docs`` (doc_id, text) by a model learnt
    from all whole texts of ``train`` (text).

    Returns doc_id, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one unigrams from exact counts) and
    score (the Bloom-filter bigram model), both log10 probabilities of the text.
    Null and empty texts are one end. Rows with equal doc_id and text come out
    as often as they went in; rows without doc_id are kept. An empty training
    table knows no token. Other columns are ignored.

    ``bits``: size of the filter that is broadcast. Where a range needs more than
    its share of them, nothing is broadcast and the n-grams of ``docs`` are
    joined with the slices, which grow with the corpus.
    ``prior``: weight of the unigrams in the bigram model. ``head``: tokens whose
    exact counts are broadcast, the most frequent ones; all others meet their
    counts in a join, so no frequent token is ever a join key.
    """
    spark = docs.sparkSession
    words = bits // 64
    packed = train.select("text").mapInArrow(count_batches, "part int, kind string, grams binary, counts binary")
    counted = stage(packed.repartition(RANGES, "part").groupBy("part").applyInPandas(build_range(words), COUNTED))

    totals = counted.agg(F.coalesce(F.max("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"), *[F.coalesce(F.sum(F.col("table")[i]), F.lit(0)).alias(f"t{i}") for i in range(MAX_LEVELS)]).first()
    n, v = int(totals["n"]), int(totals["v"])
    floor, held = MAX_LEVELS, 0
    while floor > 1 and held + totals[f"t{floor - 1}"] <= head:
        floor -= 1
        held += totals[f"t{floor}"]
    least = 1 << (floor - 1)  # counts from here on are in the head

    size = words // RANGES
    fits = totals["size"] <= size
    shared_bloom = None
    if fits:
        bloom = np.zeros(words, U)
        for turn in range(8):  # an eighth of the slices at a time
            for row in counted.where(F.col("part") % 8 == turn).select("part", "slice").collect():
                bloom[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(zlib.decompress(row["slice"]), U)
        shared_bloom = spark.sparkContext.broadcast(bloom)
        del bloom

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                gram, c = np.frombuffer(row.grams, np.int64), np.frombuffer(row.counts, np.int64)
                yield pd.DataFrame([(gram[c >= least].tobytes(), c[c >= least].tobytes())], columns=["grams", "counts"])

    packs = counted.select("grams", "counts")
    chosen = packs.mapInPandas(frequent, "grams binary, counts binary").collect()
    gram = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["grams"], np.int64) for x in chosen)])
    c = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["counts"], np.int64) for x in chosen)])
    order = np.argsort(gram)
    shared_head = spark.sparkContext.broadcast((gram[order], c[order]))

    # Ids, keys and texts of a slice, and what finds the levels of its n-grams.
    Slice = tuple[pa.Array, pa.Array, list, Callable[[np.ndarray], np.ndarray]]

    def by_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
        for batch in text_pieces(batches, SLICE):
            yield batch.column("doc_id"), batch.column("key"), batch.column("text").to_pylist(), functools.partial(levels, shared_bloom.value)

    def by_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids, keys, texts = (row.column(c).flatten() for c in ("doc_ids", "keys", "texts"))
                texts = texts.to_pylist()
                known = asked(*sequences(texts))
                found = np.frombuffer(b"".join(x["found"] for x in row.column("found")[0].as_py()), np.uint8).astype(np.int64)
                yield ids, keys, texts, lambda grams, known=known, found=found: found[np.searchsorted(known, grams)]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = shared_head.value
        for ids, keys, texts, look_up in (by_filter if fits else by_answers)(batches):
            tokens, offsets = sequences(texts)
            before = bigrams(tokens, offsets)
            owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
            unique, place = np.unique(mix(tokens ^ WORD), return_inverse=True)
            seen = low(look_up(unique))
            p_word = (seen[place] + 1) / (n + v + 1)
            pairs, pair_place = np.unique(combine(before, tokens) ^ PAIR, return_inverse=True)
            together = low(look_up(pairs))[pair_place]
            # The word before is one of the tokens, or the start, which is as frequent as the end.
            lead = np.where(before == START, END, before)
            firsts, first_place = np.unique(mix(lead ^ WORD), return_inverse=True)
            context = high(look_up(firsts))[first_place]
            scores = np.log10((together + prior * p_word) / (context + prior))
            total = np.bincount(owner, scores, len(texts))

            at = np.minimum(np.searchsorted(grams, unique.view(np.int64)), max(len(grams) - 1, 0))
            hit = grams[at] == unique.view(np.int64) if len(grams) else np.zeros(len(unique), bool)
            c = np.where(hit, counts[at], 0) if len(grams) else np.zeros(len(unique), np.int64)
            in_head = hit[place]
            own = np.bincount(owner, np.where(in_head, np.log10(c[place] + 1.0), 0.0), len(texts))
            n_known = np.bincount(owner, in_head & (c[place] > 0), len(texts)).astype(np.int64)
            tail_owner, tail_gram = owner[~in_head], unique.view(np.int64)[place[~in_head]]
            order = np.lexsort((tail_gram, tail_owner))
            tail_owner, tail_gram = tail_owner[order], tail_gram[order]
            first = np.flatnonzero(np.r_[True, (tail_owner[1:] != tail_owner[:-1]) | (tail_gram[1:] != tail_gram[:-1])]) if len(order) else np.zeros(0, np.int64)
            times = np.diff(np.r_[first, len(order)])
            bounds = np.searchsorted(tail_owner[first], np.arange(len(texts) + 1))
            ends = pa.array(bounds, pa.int32())
            tails = [pa.ListArray.from_arrays(ends, pa.array(column, pa.int64())) for column in (tail_gram[first], times)]
            columns = [ids, keys, np.diff(offsets), n_known, own, total, *tails]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["doc_id", "key", "n_tokens", "n_known", "own", "score", "tail", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))
    texts = docs.select("doc_id", key.alias("key"), "text")
    source, shown = (texts, kind) if fits else (answered(texts, counted), "string")
    weighed = stage(
        source.mapInArrow(weigh, f"doc_id {shown}, key string, n_tokens long, n_known long, own double, score double, tail array<long>, times array<long>").withColumn("doc_id", F.col("doc_id").cast(kind))
    )
    if shared_bloom is not None:
        shared_bloom.destroy()  # what it was for is written
    shared_head.destroy()
    # Rarer tokens meet their exact counts in a join, and the sums come back per
    # text. Rows that are equal share a key, so its sum is that of all of them.
    rare = packs.mapInPandas(unigram_rows, "gram long, c long").where(F.col("c") < least)
    entries = weighed.select("key", F.explode(F.arrays_zip("tail", "times")).alias("e")).select("key", F.col("e.tail").alias("gram"), F.col("e.times").alias("times"))
    met = (
        entries.join(rare, "gram")
        .groupBy("key")
        .agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare"), F.sum("times").alias("rare_known"))
    )
    copies = F.count("*").over(Window.partitionBy("key"))
    rows = weighed.drop("tail", "times").withColumn("copies", copies).join(met, "key", "left")
    size = float(n + v + 1)
    return rows.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("rare_known") / F.col("copies"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("own") + F.coalesce(F.col("rare") / F.col("copies"), F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(size))).alias("base_score"),
        "score",
    )


def score_held_out(docs: DataFrame, **how) -> DataFrame:
    """:func:`score` of all documents, learning from those outside fold 2 of 7
    (crc32 of doc_id as text), with ``held_out`` for that fold."""
    train = docs.where(outside_fold(F.col("doc_id"), 7, 2))
    return score(docs, train, **how).withColumn("held_out", in_fold(F.col("doc_id"), 7, 2))
