"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded by the library itself; those that
come back as one single token form the proven set. A pre-token in that set
counts one, without any merging. Only the rest is merged, each distinct string
once per slice of text.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how the byte-level pre-tokenizer splits text.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same as far as white space goes: no pre-token crosses these chunks.
CHUNK = regex.compile(r" ?\S+|\s+(?!\S)|\s+")
FAST_CHUNK = re.compile(r" ?[^\t-\r \x85\xa0]+|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+")
#: Chunks kept with their counts between slices of one worker, and how long they may be.
REMEMBER, LONG = 1 << 20, 32
#: Code points compared between the two engines: the planes with letters, numbers and spaces.
PLANES = 0x34000


def load(file: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return Tokenizer.from_file(public_tokenizers.path(file))


def odd_characters(library, split: regex.Pattern) -> np.ndarray:
    """Code points that the two regular-expression engines put in different
    classes (their Unicode versions differ)."""
    found, block = {0xD800}, 1 << 14
    for first in range(0, PLANES, block):
        chars = [c for c in range(first, first + block) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1{chr(c)}." for c in chars)
        theirs = {span for _, span in library.pre_tokenizer.pre_tokenize_str(text)}
        ours = {m.span() for m in split.finditer(text)}
        found.update(chars[min(start // 5, len(chars) - 1)] for start, _ in theirs ^ ours)
    return np.array(sorted(found))


@functools.lru_cache(maxsize=4)
def prove(file: str) -> tuple[frozenset[str], np.ndarray]:
    """Vocabulary strings that are one pre-token and encode alone as one token,
    and the code points whose texts must go to the library whole."""
    library, split = load(file), regex.compile(PRE_TOKEN)
    added = {token.content for token in library.get_added_tokens_decoder().values()}
    strings = {library.decode([i], skip_special_tokens=False) for i in range(library.get_vocab_size())} - added
    strings = [s for s in strings if s and "\ufffd" not in s and split.fullmatch(s)]
    encoded = library.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1), odd_characters(library, split)


class Counting:
    """Counts tokens of texts as the library for ``file`` gives them."""

    def __init__(self, file: str, proof: tuple[frozenset[str], np.ndarray]) -> None:
        self.library, self.split = load(file), regex.compile(PRE_TOKEN)
        self.single, odd = proof
        self.odd = np.zeros(0x110000, bool)
        self.odd[odd] = True
        self.odd[0xD800:0xE000] = True
        added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.seen: dict[str, int] = {}

    def _merged(self, pieces: list[str]) -> dict[str, int]:
        """Token counts by the library's merges, on its alphabet of bytes."""
        merge = self.library.model.tokenize
        return {p: len(merge(p.encode().decode("latin-1").translate(self.alphabet))) for p in pieces}

    def _learn(self, chunks: set[str]) -> dict[str, int]:
        """Token counts of chunks: proven pre-tokens count one, the rest is merged."""
        single, split = self.single, self.split.findall
        table = dict.fromkeys(chunks & single, 1)
        parts = {chunk: split(chunk) for chunk in chunks - single}
        merged = self._merged(list({p for pieces in parts.values() for p in pieces if p not in single}))
        for chunk, pieces in parts.items():
            table[chunk] = sum(merged.get(p, 1) for p in pieces)
        return table

    def count(self, texts: list[str]) -> list[int]:
        totals, chunked = [], []
        for text in texts:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            if self.odd[codes].any():
                totals.append(len(self.library.encode(text, add_special_tokens=False).ids))
                chunked.append(())
                continue
            parts = self.added.split(text) if self.added else [text]
            find = FAST_CHUNK.findall if len(codes) and codes.max() < 0x1680 and not ((codes > 27) & (codes < 32)).any() else CHUNK.findall
            totals.append(len(parts) - 1)
            chunked.append(find(text) if len(parts) == 1 else [c for part in parts for c in find(part)])
        table = {}
        unknown = set()
        for chunk in set().union(*chunked):
            known = self.seen.get(chunk)
            if known is None:
                unknown.add(chunk)
            else:
                table[chunk] = known
        if unknown:
            learnt = self._learn(unknown)
            table |= learnt
            for chunk, n in learnt.items():
                if len(self.seen) < REMEMBER and len(chunk) <= LONG:
                    self.seen[chunk] = n
        return [total + sum(map(table.__getitem__, chunks)) for total, chunks in zip(totals, chunked, strict=True)]


#: Characters counted in one go.
SLICE = 6 << 20


def count_tokens(docs: DataFrame, file: str = "byte_bpe_50k.json", limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` (``doc_id`` and ``text``; other columns are ignored) with the
    token count of every whole text: doc_id, n_bytes (UTF-8), n_tokens,
    over_limit (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. Strings of special tokens
    inside a text count as the library counts them. Repeated rows are repeated
    in the result, rows without doc_id are kept, an empty table gives none. What
    is broadcast depends on the vocabulary alone.
    """

    proof = docs.sparkSession.sparkContext.broadcast(prove(file))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counting(file, proof.value)
        for batch in batches:
            texts, totals, held, size = batch["text"].tolist(), [], [], 0
            for one in texts:
                held.append(one)
                size += len(one)
                if size >= SLICE:
                    totals += counter.count(held)
                    held, size = [], 0
            totals += counter.count(held)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": totals})

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInPandas(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
