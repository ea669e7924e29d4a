"""Token counts under a unigram model, with one forward pass per shared prefix.

The best segmentation score of a prefix depends on the prefix alone, so a task
puts the distinct pre-tokens of a block in a trie and computes each node once:
a pre-token only pays for the characters past the prefix it shares. Counts at
terminal nodes serve every later occurrence as a lookup.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import text_blocks

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MAX_WORDS = 1 << 19  # pre-tokens whose counts a task remembers between blocks
# a space belongs to the word after it; other white space stands alone
PRE_TOKEN = re.compile(r" ?\S+|\s")


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces of a vocabulary file with unigram scores. The file ranks its
    pieces; the scores are log probabilities by Zipf's law over those ranks.
    Control, unknown and byte pieces are left out: what no piece covers is
    counted by its bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(names))) or 1.0)
    return {p: -math.log(r + 1) - total for r, p in enumerate(names)}


class PrefixTrie:
    """Forward scores of pre-tokens, shared by prefix.

    Pre-tokens enter in sorted order, which walks their trie depth first, so
    the scores along the current path are all that has to be kept; terminal
    nodes leave their token count in ``counts``.
    """

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        # a string that no piece ends with: no longer piece can end here
        self.tails = {p[i:] for p in pieces for i in range(len(p))}
        self.byte = min(pieces.values(), default=0.0) - 10.0
        self.counts: dict[str, int] = {}

    def insert(self, words: list[str]) -> None:
        """Store the token counts of new pre-tokens."""
        pieces, tails, counts = self.pieces, self.tails, self.counts
        score, tokens, last = [0.0], [0], ""
        for word in sorted(words):
            text = word.replace(" ", SPACE)
            shared, top = 0, min(len(text), len(last))
            while shared < top and text[shared] == last[shared]:
                shared += 1
            del score[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                width = len(text[end - 1].encode("utf-8", "surrogatepass"))
                best, n = score[end - 1] + self.byte * width, tokens[end - 1] + width
                for i in range(end - 1, -1, -1):
                    tail = text[i:end]
                    own = pieces.get(tail)
                    if own is not None:
                        s, c = score[i] + own, tokens[i] + 1
                        if s > best or s == best and c < n:
                            best, n = s, c
                    elif tail not in tails:
                        break
                score.append(best)
                tokens.append(n)
            counts[word] = tokens[-1]
            last = text

    def texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of every whole text."""
        seen = [Counter(PRE_TOKEN.findall(" " + t)) if t else Counter() for t in texts]
        new = set().union(*seen)
        fresh = [w for w in new if w not in self.counts]
        if len(fresh) + len(self.counts) > MAX_WORDS:
            self.counts.clear()
            fresh = list(new)
        self.insert(fresh)
        get = self.counts.__getitem__
        return [(sum(map(mul, map(get, c.keys()), c.values())), c.total()) for c in seen]


_TRIES: dict[int, PrefixTrie] = {}


def _worker_trie(pieces: dict[str, float]) -> PrefixTrie:
    """The trie of this Python worker, kept from task to task."""
    key = hash(tuple(pieces.items()))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = PrefixTrie(pieces)
    return _TRIES[key]


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, n_pretokens, n_chars) for every row.

    Whole texts are counted, with a space put before the first word. Null and
    empty texts have no tokens. Characters outside the vocabulary count one
    token per UTF-8 byte. Rows repeat as often as the input, other columns are
    ignored, an empty table gives no rows. No shuffle; a task remembers a bounded number of words.
    """
    pieces = load_pieces(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _worker_trie(pieces)
        for b in text_blocks(batches):
            texts = b.column("text").to_pylist()
            counts = trie.texts([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([c for c, _ in counts], pa.int64()),
                 pa.array([n for _, n in counts], pa.int64()),
                 pa.array([len(t or "") for t in texts], pa.int64())],
                names=["doc_id", "n_tokens", "n_pretokens", "n_chars"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
                             "n_pretokens bigint, n_chars bigint")
