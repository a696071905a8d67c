"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a run of characters other than white space, with the word mark in front. Its tokens are those of
the best segmentation into vocabulary pieces: the highest sum of piece scores, fewer tokens on equal sums. A
character that no piece covers falls back to its UTF-8 bytes, one token each. Best score and token count of a
prefix depend on that prefix alone, so each trie node holds both, computed once when the node is made, for all
pre-tokens that share it; a terminal node's count is its pre-token's. Texts then only sum terminal counts.

The vocabulary file is a parameter; nothing is trained. A piece's score is the logarithm of a Zipf probability
over its rank in the file. Every task builds its own trie from the texts it reads, and starts a new one when it
has NODES nodes, so memory is bounded, nothing is shuffled, and a lost executor only repeats its tasks.
Pre-tokens over LONG characters don't enter the trie; the same recurrence runs along them once.

Defined cases: null or empty text has no tokens; texts of any length are counted whole; repeated rows count
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, column, pieces, read

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NODES, LONG = 500_000, 64
_MODELS: dict[str, "Unigram"] = {}


class Unigram:
    """Piece scores and the forward recurrence; a prefix's state is (score, tokens)."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        self.tails = {p[k:] for p in scores for k in range(len(p))}  # no piece ends in anything else
        self.reset()

    @classmethod
    def load(cls, path: str) -> Unigram:
        """From a SentencePiece model, scores by rank: -ln(rank + 1) - ln(harmonic number)."""
        if path not in _MODELS:
            from sentencepiece import SentencePieceProcessor

            sp = SentencePieceProcessor(model_file=path)
            kept = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
            norm = math.log(sum(1 / (k + 1) for k in range(len(kept))))
            scores = {sp.id_to_piece(i): -math.log(k + 1) - norm for k, i in enumerate(kept)}
            _MODELS[path] = cls(scores, -math.log(len(kept) + 1) - norm)
        return _MODELS[path]

    def reset(self) -> None:
        """An empty trie: children by node and character, per node its best score and number of tokens; terminal: tokens by word."""
        self.children: dict[int, int] = {}
        self.states: list[tuple[float, int]] = [(0.0, 0)]
        self.terminal: dict[str, int] = {}

    def step(self, text: str, stop: int, states: list[tuple[float, int]]) -> tuple[float, int]:
        """The state of text[:stop] from those of its last prefixes: states[-k] belongs to text[:stop - k]."""
        n = len(text[stop - 1].encode("utf-8", "surrogatepass"))
        score, tokens = states[-1]
        top, count = score + n * self.byte_score, tokens + n
        get, tails = self.scores.get, self.tails
        for k in range(1, min(stop, len(states)) + 1):
            tail = text[stop - k : stop]
            if tail not in tails:
                break
            own = get(tail)
            if own is not None:
                s, c = states[-k]
                s, c = s + own, c + 1
                if s > top or s == top and c < count:
                    top, count = s, c
        return top, count

    def count(self, word: str) -> int:
        """Tokens of one pre-token, given without its mark."""
        found = self.terminal.get(word)
        if found is not None:
            return found
        marked = MARK + word
        if len(marked) > LONG:
            states = [(0.0, 0)]
            for stop in range(1, len(marked) + 1):
                states.append(self.step(marked, stop, states))
                if len(states) > self.longest + 1:
                    del states[0]
            return states[-1][1]
        if len(self.states) > NODES:
            self.reset()
        node, states, children, every = 0, [(0.0, 0)], self.children, self.states
        for stop, c in enumerate(marked, 1):
            key = node * 0x110000 + ord(c)
            child = children.get(key)
            if child is None:
                child = children[key] = len(every)
                every.append(self.step(marked, stop, states))
            node = child
            states.append(every[node])
        self.terminal[word] = every[node][1]
        return every[node][1]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_chars, n_pretokens, n_tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram.load(vocabulary)
        model.reset()
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                chars, words, tokens = [], [], []
                for text in column(part, "text"):
                    found = (text or "").split()
                    chars.append(len(text or ""))
                    words.append(len(found))
                    counts = list(map(model.terminal.get, found))
                    if None in counts:
                        counts = [model.count(w) if n is None else n for w, n in zip(found, counts, strict=True)]
                    tokens.append(sum(counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), *(pa.array(x, pa.int64()) for x in (chars, words, tokens))],
                    names=["doc_id", "n_chars", "n_pretokens", "n_tokens"],
                )

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return table.transform(arrow, run, "doc_id long, n_chars long, n_pretokens long, n_tokens long")


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
