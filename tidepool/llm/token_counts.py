"""Operator 7: token counts under a unigram model, with dynamic programming shared in a trie.

Pre-tokens come and go as in ``pretokens``: each distinct one reaches one task once.  There
it is inserted in a trie of bytes.  Every node holds the forward score of its prefix, the
least cost of cutting it into vocabulary tokens, and the number of tokens of that cut
(fewer on a tie); it is computed once, from the nodes above it, whichever words share it.
The node where a word ends gives the word's count.

The model: token of rank r has the Zipf probability 1 / ((r + 1) * H); costs are its
negative logarithm in whole millionths, so equal cuts are equal on any machine.

Defined results: a null or empty text has no tokens; texts of any length are read whole;
repeated rows give repeated rows; an empty table gives an empty table; ids may be null;
only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.bpe import parse_ranks
from tidepool.llm.pretokens import cut, reassemble, solve_words


def costs(ranks: bytes) -> dict[bytes, int]:
    found = parse_ranks(ranks)
    norm = math.log(math.fsum(1 / (r + 1) for r in found.values())) if found else 0.0
    return {t: round(1e6 * (math.log(r + 1) + norm)) for t, r in found.items()}


def _counter(ranks: bytes) -> Callable:
    cache: list = []

    def make():
        if not cache:
            vocabulary = costs(ranks)
            cache.append((vocabulary, max(map(len, vocabulary), default=0)))
        vocabulary, longest = cache[0]
        child: dict[int, int] = {}          # node << 8 | byte -> node
        forward = [(0, 0)]                  # node -> (cost, tokens) of its prefix

        def solve(words):
            for w in words:
                node, depth, path = 0, 0, [0]
                for byte in w:
                    node_below = child.get(node << 8 | byte)
                    depth += 1
                    if node_below is None:
                        best = None
                        for start in range(depth - 1, max(0, depth - longest) - 1, -1):
                            cost = vocabulary.get(w[start:depth])
                            if cost is not None:
                                above = forward[path[start]]
                                score = (above[0] + cost, above[1] + 1)
                                if best is None or score < best:
                                    best = score
                        if best is None:
                            raise ValueError("the vocabulary has no token for a byte")
                        node_below = child[node << 8 | byte] = len(forward)
                        forward.append(best)
                    node = node_below
                    path.append(node)
                yield forward[node][1], b""

        return solve

    return make


def token_counts(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_words, n_tokens."""
    blocks = cut(docs, pattern, id_col, text_col)
    return reassemble(blocks, solve_words(blocks, _counter(ranks)), values=False).select(
        F.col("id").alias(id_col), "n_words", F.col("n").alias("n_tokens"))
