"""Numbers of greedy word pieces, by an automaton that reads each character once.

The vocabulary's pieces, those that begin a word and those that go on, stand in a trie. A node that cannot go on follows its failure link:
to the node that stands for what is left once the longest pieces are taken, with the number of pieces taken ready; so a word's
longest-match count is a sum over the links followed, and no piece is built.

Rows: null and empty texts have no words. A word that the vocabulary cannot spell is one unknown piece. Words are whole, whatever their length.
Other columns are kept; the three new ones replace columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from valora.llm.common import Memo, slices

UNKNOWN = -1


class Automaton:
    """``initial`` pieces begin a word, ``further`` ones go on; pieces are plain strings."""

    def __init__(self, initial: list[str], further: list[str]):
        # Node 0 is the start of a word, node 1 the place after a piece.
        self.next: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, initial), (1, further)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    node = self.next[node][c]
                ends[node] = ends[node] or bool(piece)
        self.fail, self.popped = [UNKNOWN] * len(self.next), [0] * len(self.next)
        level = [0, 1]
        while level:
            deeper = []
            for u in level:
                for c, v in self.next[u].items():
                    deeper.append(v)
                    if ends[v]:
                        self.fail[v], self.popped[v] = 1, 1
                        continue
                    z, taken = self.fail[u], self.popped[u]
                    while z != UNKNOWN and c not in self.next[z]:
                        taken += self.popped[z]
                        z = self.fail[z]
                    if z != UNKNOWN:
                        self.fail[v], self.popped[v] = self.next[z][c], taken
            level = deeper

    def count(self, word: str) -> int:
        """Pieces of a word by longest match, or UNKNOWN."""
        node, total, nodes, fail, popped = 0, 0, self.next, self.fail, self.popped
        for c in word:
            while c not in nodes[node]:
                total += popped[node]
                node = fail[node]
                if node == UNKNOWN:
                    return UNKNOWN
            node = nodes[node][c]
        while node != 1 and word:
            total += popped[node]
            node = fail[node]
            if node == UNKNOWN:
                return UNKNOWN
        return total


def sentence_pieces(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """(initial, further) pieces of a sentencepiece model: those with and without the mark of a word's beginning."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in pieces if p[:1] == mark and p[1:]], [p for p in pieces if mark not in p]


def piece_counts(documents: DataFrame, initial: list[str], further: list[str], *, text_col: str = "text") -> DataFrame:
    """The documents with n_words, n_pieces and n_unknown (words that are one unknown piece, counted in n_pieces too)."""
    shared = documents.sparkSession.sparkContext.broadcast((initial, further))
    names = ["n_words", "n_pieces", "n_unknown"]
    kept = [c for c in documents.columns if c not in names]

    def run(batches):
        counts = Memo(Automaton(*shared.value).count)
        for batch in slices(batches):
            found = []
            for text in batch.column(text_col).to_pylist():
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n = np.fromiter(map(counts.__getitem__, [w.decode("utf-8", "surrogatepass") for w in words]), np.int64, len(words))
                found.append((len(words), int(np.abs(n).sum()), int((n == UNKNOWN).sum())))
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, pa.int64()) for c in columns)], names=[*kept, *names])

    schema = T.StructType([*(documents.schema[c] for c in kept), *(T.StructField(n, T.LongType()) for n in names)])
    return documents.select(*kept, *([] if text_col in kept else [text_col])).mapInArrow(run, schema)
