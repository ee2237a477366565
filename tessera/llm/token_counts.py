"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a trie with failure links: a node stands for the text read
since the last piece that is certain. Where the next character has no child,
the link leads to the node of what remains after the longest pieces are
popped, and the node knows how many those are, so a word's number of pieces
comes out in one pass without building a piece.

A text is lower-cased and split into runs of word characters and runs of other
visible characters; a word with an unmatched part counts as one unknown token.
The vocabulary is a file of a public tokenizer, whose pieces are spelled in
bytes; the mark ``</w>`` of those that end a word is left out, so that a piece
fits anywhere in a word. The vocabulary's size bounds the broadcast.

Null and empty texts count 0; repeated rows count each; extra columns are
ignored; words of any length are matched whole.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows

CACHE_WORDS = 300_000
WORDS = re.compile(r"\w+|[^\w\s]+")


def byte_letters() -> list[str]:
    """The letters of byte-level vocabularies: visible Latin-1 bytes as themselves, the others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


class PieceCounter(dict):
    """Word -> number of pieces (0: unknown); a dictionary that fills itself from the automaton."""

    def __init__(self, pieces: list[str], spell=None):
        super().__init__()
        self.spell = spell or str
        self.children: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            at = 0
            for c in piece:
                at = self.children[at].setdefault(c, len(self.children))
                if at == len(self.children):
                    self.children.append({})
                    whole.append(False)
            whole[at] = at > 0
        self.fail, self.popped = [-1] * len(whole), [0] * len(whole)
        queue = [0]
        for parent in queue:  # breadth first
            for c, node in self.children[parent].items():
                queue.append(node)
                if whole[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.children[at]:
                    at, popped = self.fail[at], popped + self.popped[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.children[at][c], popped

    def __missing__(self, word: str) -> int:
        children, fail, popped = self.children, self.fail, self.popped
        at = n = 0
        for c in self.spell(word):
            while c not in children[at]:
                n += popped[at]
                at = fail[at]
                if at < 0:
                    self[word] = 0
                    return 0
            at = children[at][c]
        while at > 0:
            n += popped[at]
            at = fail[at]
        self[word] = n if at == 0 else 0
        return self[word]


def byte_spelling():
    """A word as the letters of its UTF-8 bytes."""
    table = {k: c for k, c in enumerate(byte_letters())}
    return lambda word: word.encode().decode("latin-1").translate(table)


def vocabulary(path: str) -> list[str]:
    """The distinct pieces of a tokenizer file, without their end mark."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    return sorted({p.removesuffix("</w>") for p in pieces})


def _count_task(shared):
    def run(batches):
        counter = PieceCounter(shared.value, byte_spelling())
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("text").to_pylist():
                if len(counter) > CACHE_WORDS:
                    counter.clear()
                own = WORDS.findall(text.lower()) if text else []
                sizes = list(map(counter.__getitem__, own))
                lost = sizes.count(0)
                words.append(len(own)), tokens.append(sum(sizes) + lost), unknown.append(lost)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (words, tokens, unknown)]],
                                             names=["doc_id", "n_words", "n_tokens", "n_unknown"])
    return run


def count_tokens(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document (doc_id, text): numbers of words, tokens and unknown words."""
    spark = documents.sparkSession
    arrow_rows(spark)
    pieces = spark.sparkContext.broadcast(vocabulary(tokenizer_path))
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_count_task(pieces), "doc_id long, n_words long, n_tokens long, n_unknown long")
