"""Language of documents from a linear-chain conditional random field over words.

Every word has a potential per language: the added weights of its affixes,
character n-grams and lexicon entries. Learned transitions connect neighbouring
words, and forward-backward labels each word given all others of its chain. A
document's language is the one with most letters of expected words.

Words are the runs of letters between white space and other characters; longer
runs than ``LONGEST`` letters, as of texts written without spaces, are cut into
words of at most that length, so every letter is looked at. Texts are read
whole; chains end after ``CHAIN`` words, so labelling a long text needs no more
memory than a short one.

The field is fitted to a bounded sample of labelled documents. The sample's
texts are laid end to end in random order before they are cut into chains, so
chains change language where documents meet and the transitions are learned from
switches too. Words of a document all carry its label.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemorph.llm.hashing import mix
from telemorph.llm.shared import in_fold, outside_fold

UNKNOWN = "und"
#: Words of a chain.
CHAIN = 64
#: Buckets of affix and n-gram features, of the lexicon after them, and one without weight.
BUCKETS = 1 << 16
LEXICON = 1 << 15
NOTHING = BUCKETS + LEXICON
#: Words kept with their potentials between batches of one worker.
REMEMBER = 1 << 18
NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+")
#: Most letters of a word; longer runs of letters are several words.
LONGEST = 32


def parts(token: str) -> list[str]:
    """The words of a token, with all its letters: cut where it has other
    characters, and long runs into pieces of nearly equal length."""
    out = []
    for run in [token] if token.isalpha() else NO_LETTER.split(token):
        count = -(-len(run) // LONGEST)
        out += [run[len(run) * i // count : len(run) * (i + 1) // count] for i in range(count)]
    return out


def short_tokens(text: str | None) -> list[str]:
    """The tokens of a text, lower-cased, long ones as their words: none is
    longer than LONGEST, so what is remembered of them is bounded."""
    tokens = text.lower().split() if text else []
    if not any(len(t) > LONGEST for t in tokens):
        return tokens
    return [w for t in tokens for w in ([t] if len(t) <= LONGEST else parts(t))]


def features(words: list[str]) -> np.ndarray:
    """Buckets of every word's features: prefixes and suffixes of up to 4
    letters, character 2- and 3-grams with its ends, and the word itself as a
    lexicon entry. Rows are padded with a bucket that has no weight."""
    width = max(1, *map(len, words)) if words else 1
    letters = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    size = np.array([len(w) for w in words])
    row = np.arange(len(words))
    shown = np.zeros((len(words), width + 3), np.uint64)
    shown[:, 0], shown[:, 1 : width + 1] = 1, letters
    shown[row, size + 1] = 2
    columns = []

    def add(kind: int, chars: list[np.ndarray], valid: np.ndarray, first: int = 0, buckets: int = BUCKETS) -> None:
        value = np.full(len(words), kind, np.uint64)
        for c in chars:
            value = value * np.uint64(0x100000001B3) + c
        bucket = (mix(value) % np.uint64(buckets)).astype(np.int32) + np.int32(first)
        columns.append(np.where(valid, bucket, np.int32(NOTHING)))

    with np.errstate(over="ignore"):
        for k in range(1, min(4, width) + 1):
            add(10 + k, [letters[:, i] for i in range(k)], size >= k)
            add(20 + k, [letters[row, np.maximum(size - k + i, 0)] for i in range(k)], size >= k)
        for i in range(width + 1):
            add(2, [shown[:, i], shown[:, i + 1]], size >= max(i, 1))
        for i in range(width):
            add(3, [shown[:, i], shown[:, i + 1], shown[:, i + 2]], size > i)
        add(4, [letters[:, i] for i in range(width)], size > 0, BUCKETS, LEXICON)
    return np.stack(columns, 1)


@dataclass
class Field:
    """What is learned: bounded by the buckets and the number of languages."""

    languages: list[str]
    weights: np.ndarray  # bucket, language
    transitions: np.ndarray  # from, to

    def potentials(self, words: list[str]) -> np.ndarray:
        """Added weights of each word's features; words of similar length go together."""
        weights = self.weights.astype(np.float32)
        out = np.zeros((len(words), len(self.languages)), np.float32)
        order = np.argsort([len(w) for w in words], kind="stable")
        for block in np.array_split(order, -(-len(order) // 8192)) if len(order) else ():
            found = features([words[i] for i in block])
            for column in found.T:
                out[block] += weights[column]
        return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every label at every place of every chain, and the expected
    transitions. scores: chain, place, label; places from a chain's length on
    are padding."""
    chains, places, labels = scores.shape
    move = np.exp(transitions)
    own = np.exp(scores - scores.max(2, keepdims=True))
    inside = np.arange(places)[None, :] < lengths[:, None]
    ahead, behind = np.empty_like(own), np.empty_like(own)
    ahead[:, 0] = own[:, 0] / own[:, 0].sum(1, keepdims=True)
    for t in range(1, places):
        step = (ahead[:, t - 1] @ move) * own[:, t]
        ahead[:, t] = step / step.sum(1, keepdims=True)
    behind[:, places - 1] = 1.0
    for t in range(places - 2, -1, -1):
        step = (behind[:, t + 1] * own[:, t + 1]) @ move.T
        step /= step.sum(1, keepdims=True)
        behind[:, t] = np.where(inside[:, t + 1, None], step, 1.0)
    posterior = ahead * behind
    posterior /= posterior.sum(2, keepdims=True)
    left, right = ahead[:, :-1], own[:, 1:] * behind[:, 1:]
    norm = np.einsum("cti,ij,ctj->ct", left, move, right, optimize=True)
    used = inside[:, 1:] / norm
    expected = np.einsum("cti,ctj,ct->ij", left, right, used, optimize=True) * move
    return posterior, expected


def chains(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sequence cut into rows of CHAIN, the last one padded with its own end."""
    count = -(-len(sequence) // CHAIN)
    padded = np.resize(sequence, count * CHAIN) if len(sequence) else sequence
    lengths = np.full(count, CHAIN)
    if count:
        lengths[-1] = len(sequence) - (count - 1) * CHAIN
    return padded.reshape(count, CHAIN), lengths


def fit(texts: list[str], languages: list[str], rounds: int = 12) -> Field:
    """Conditional log likelihood of the labels, climbed with scaled gradient
    steps and a Gaussian prior. No labelled word: every word is unknown."""
    names = sorted(set(languages))
    rng = np.random.default_rng(7)
    words, labels = [], []
    for i in rng.permutation(len(texts)):
        found = [w for t in texts[i].lower().split() for w in parts(t)]
        words += found
        labels += [names.index(languages[i])] * len(found)
    if not words:
        return Field(names[:1] or [UNKNOWN], np.zeros((NOTHING + 1, 1)), np.zeros((1, 1)))
    codes, vocabulary = pd.factorize(np.array(words, object))
    found = features(list(vocabulary))
    real = found < NOTHING
    used, flat = np.unique(found[real], return_inverse=True)
    owner = np.nonzero(real)[0]
    starts = np.searchsorted(owner, np.arange(len(vocabulary)))
    grid, lengths = chains(codes)
    truth, _ = chains(np.array(labels))
    inside = np.arange(CHAIN)[None, :] < lengths[:, None]
    count = len(names)
    weights, moves = np.zeros((len(used), count)), np.zeros((count, count))
    seen_w, seen_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    counted = np.zeros((len(vocabulary), count))
    np.add.at(counted, (grid[inside], truth[inside]), 1.0)
    step_truth = np.zeros((count, count))
    np.add.at(step_truth, (truth[:, :-1][inside[:, 1:]], truth[:, 1:][inside[:, 1:]]), 1.0)
    for _ in range(rounds):
        scores = np.add.reduceat(weights[flat], starts)
        posterior, steps = forward_backward(scores[grid], lengths, moves)
        posterior[~inside] = 0.0
        expected = np.stack([np.bincount(grid.ravel(), posterior[:, :, k].ravel(), len(vocabulary)) for k in range(count)], 1)
        gap = counted - expected
        gradient = np.stack([np.bincount(flat, gap[owner, k], len(used)) for k in range(count)], 1) - 0.1 * weights
        seen_w += gradient**2
        weights += 0.3 * gradient / np.sqrt(seen_w)
        change = step_truth - steps - 0.1 * moves
        seen_m += change**2
        moves += 0.3 * change / np.sqrt(seen_m)
    whole = np.zeros((NOTHING + 1, count))
    whole[used] = weights
    return Field(names, whole, moves)


def learn(labelled: DataFrame, sample: int = 600) -> Field:
    """A field from about ``sample`` documents of ``labelled`` (doc_id, text,
    lang), the same share of every language's documents up to an equal number
    of each. Documents without text or lang teach nothing."""
    usable = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    share = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = max(1, sample // max(1, len(share)))
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 30))
    limit = F.lit(0)
    for lang, n in sorted(share.items()):
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, each / n) * (1 << 30)))).otherwise(limit)
    drawn = usable.withColumn("draw", draw).where(F.col("draw") < limit).orderBy("draw", "doc_id").limit(2 * sample).collect()
    return fit([r["text"] for r in drawn], [r["lang"] for r in drawn])


class Labelling:
    """Labels texts with a field; remembers the potentials of words."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.ids: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.scores = np.zeros((0, len(self.field.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)
        self.ends = np.zeros(1, np.int64)

    def look_up(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the tokens' words in the tables of potentials and letters, and
        which token each belongs to. Tokens without letters have no word."""
        if len(self.ids) > REMEMBER:
            self.forget()
        codes = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        new = list(itertools.islice(self.ids, len(self.ends) - 1, None))
        if new:
            found = [parts(t) for t in new]
            words = [w for own in found for w in own]
            self.scores = np.concatenate([self.scores, self.field.potentials(words)])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, words), np.int64, len(words))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        counts = self.ends[codes + 1] - self.ends[codes]
        token = np.repeat(np.arange(len(codes)), counts)
        nth = np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.ends[codes][token] + nth, token

    def label(self, texts: list) -> tuple[list[str], list[float]]:
        found = [short_tokens(t) for t in texts]
        codes, token = self.look_up([w for words in found for w in words])
        owner = np.repeat(np.arange(len(texts)), [len(words) for words in found])[token]
        letters, table = self.letters[codes], self.scores
        counts = np.bincount(owner, minlength=len(texts))
        if not len(codes):
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        per_text = -(-counts // CHAIN)
        starts = np.cumsum(counts) - counts
        chain_owner = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(chain_owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        chain_start = starts[chain_owner] + nth * CHAIN
        lengths = np.minimum(CHAIN, starts[chain_owner] + counts[chain_owner] - chain_start)
        votes = np.zeros((len(texts), len(self.field.languages)))
        order = np.argsort(lengths, kind="stable")
        for block in np.array_split(order, -(-len(order) // 2048)):
            width = lengths[block].max()
            at = np.minimum(chain_start[block, None] + np.arange(width), len(codes) - 1)
            inside = np.arange(width)[None, :] < lengths[block, None]
            posterior = label_chains(table[codes[at]], inside, self.field.transitions)
            posterior *= (letters[at] * inside)[:, :, None]
            np.add.at(votes, chain_owner[block], posterior.sum(1))
        total = votes.sum(1)
        best = votes.argmax(1)
        share = votes[np.arange(len(texts)), best] / np.maximum(total, 1e-300)
        return (
            [self.field.languages[b] if n else UNKNOWN for b, n in zip(best, counts, strict=True)],
            np.where(counts > 0, np.clip(share, 0.0, 1.0), 0.0).tolist(),
        )


def label_chains(scores: np.ndarray, inside: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posteriors alone, as :func:`forward_backward` gives them, in single precision."""
    places = scores.shape[1]
    move = np.exp(transitions).astype(np.float32)
    own = np.exp(np.maximum(scores - scores.max(2, keepdims=True), -60.0))
    ahead = np.empty_like(own)
    ahead[:, 0] = own[:, 0] / own[:, 0].sum(1, keepdims=True)
    for t in range(1, places):
        step = (ahead[:, t - 1] @ move) * own[:, t]
        ahead[:, t] = step / np.maximum(step.sum(1, keepdims=True), 1e-30)
    behind = np.ones_like(own[:, 0])
    back = np.ascontiguousarray(move.T)
    for t in range(places - 2, -1, -1):
        step = (behind * own[:, t + 1]) @ back
        behind = np.where(inside[:, t + 1, None], step / np.maximum(step.sum(1, keepdims=True), 1e-30), 1.0).astype(np.float32)
        ahead[:, t] *= behind
    return ahead / np.maximum(ahead.sum(2, keepdims=True), 1e-30)


LETTER = regex.compile(r"\p{L}")


def identify_rows(docs: DataFrame, field: Field) -> DataFrame:
    """All rows of ``docs`` (text and any others) with lang_pred and lang_score
    (share of the letters expected in that language, 0 to 1).

    ``und`` with score 0 for texts that are null or have no letter. Equal rows
    get equal results; an empty table gives none; columns named like those added
    are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.drop("lang_pred", "lang_score")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labelling = Labelling(shared.value)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                found, scores = labelling.label(texts)
                # Marks alone form words for the field, but no language.
                lettered = [bool(LETTER.search(text or "")) for text in texts]
                found = [name if has else UNKNOWN for name, has in zip(found, lettered, strict=True)]
                scores = [score if has else 0.0 for score, has in zip(scores, lettered, strict=True)]
                columns = [*part.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "lang_pred", "lang_score"])

    return rows.mapInArrow(label, T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]))


def slices(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of some ``size`` bytes of text each."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0))
    group = np.cumsum(lengths) // size
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    for a, b in zip(starts, np.r_[starts[1:], len(group)], strict=True):
        yield batch.slice(a, b - a)


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text), as
    :func:`identify_rows` finds them; other columns are ignored."""
    return identify_rows(docs.select("doc_id", "text"), field).select("doc_id", "lang_pred", F.col("lang_score").alias("score"))


def identify_held_out(docs: DataFrame, sample: int = 600) -> DataFrame:
    """:func:`identify` of all documents, learning from those outside fold 2 of 4."""
    field = learn(docs.where(outside_fold(F.col("doc_id"), 4, 2)), sample)
    return identify(docs, field).withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
