"""Token counts under a unigram vocabulary, by dynamic programming over a trie.

A text's pre-tokens are its white-space separated words, each led by the word
mark.  The distinct pre-tokens of a batch are walked in sorted order, which is a
depth-first walk of their trie: the best forward score and token count of every
trie node (a prefix) are computed once, shared by all pre-tokens below it, and
the count at each terminal is stored.  A text's count is the sum over its words.

Scores: the vocabulary file's order gives a Zipf rank r, and a piece's score is
-ln(r + 10).  A character outside the vocabulary takes its UTF-8 bytes as tokens,
at ten below the lowest score for each.  Equal scores go to fewer tokens.

Defined results: null and empty texts have no token; counts are over the whole
text; repeated rows are counted each.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import LONG_WORD, give_back_memory, table, text_slices, vocabulary_path, worker_memo

MARK = "▁"


def load_scores(path: str) -> dict[str, float]:
    """Piece to score, from a sentencepiece file; control, unknown and byte pieces are left out."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {piece: -math.log(rank + 10) for rank, piece in enumerate(pieces)}


def trie_counts(pretokens: Iterable[str], scores: dict[str, float]) -> dict[str, int]:
    """Token count of each pre-token; every shared prefix is scored once."""
    longest = max(map(len, scores), default=1)
    unknown = min(scores.values(), default=0.0) - 10.0
    get, terminal, before = scores.get, {}, ""
    best: list[tuple[float, int]] = [(0.0, 0)]  # of the prefix of each length on the current path: score, minus tokens
    for word in sorted(set(pretokens)):
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            last = word[end - 1]
            top = None
            for start in range(max(0, end - longest), end):
                score = get(word[start:end])
                if score is not None:
                    reached = (best[start][0] + score, best[start][1] - 1)
                    if top is None or reached > top:
                        top = reached
            if last not in scores:
                n = len(last.encode("utf-8", "replace"))
                reached = (best[end - 1][0] + n * unknown, best[end - 1][1] - n)
                if top is None or reached > top:
                    top = reached
            best.append(top)
        terminal[word] = -best[-1][1]
        before = word
    return terminal


def count_udf(path: str):
    @F.pandas_udf("n_pretokens long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = worker_memo(f"unigram:{path}", 1 << 30)
        if not scores:
            scores.update(load_scores(path))
        for texts in batches:
            out = []
            for own in text_slices(texts):
                memo = worker_memo(f"counts:{path}")
                words = [text.split() for text in own]
                new = set().union(*words).difference(memo)
                memo.update((w[1:], n) for w, n in trie_counts((MARK + w for w in new), scores).items())
                out += [(len(w), sum(map(memo.__getitem__, w))) for w in words]
                for w in new:
                    if len(w) > LONG_WORD:
                        del memo[w]
            yield pd.DataFrame(out, columns=["n_pretokens", "n_tokens"])
            give_back_memory()

    return count


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_pretokens, n_tokens) per row."""
    path = path or vocabulary_path("piece_bpe_32k.model")
    return docs.select(F.col(id_col), count_udf(path)(F.col(text_col)).alias("_c")).select(id_col, "_c.*")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
