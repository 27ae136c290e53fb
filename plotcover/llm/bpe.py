"""Exact encoding with a published tokenizer file, one distinct piece at a time.

The tokenizer's normalizer (NFC, white space, lower case) and its
pre-tokenizer never reach across white space: no composition, pattern match,
added token or merge spans a blank.  So a text's ids are the ids of its
blank-separated words in order.  A plain word (ASCII and Latin-1 letters, no
apostrophe, no added token) is cut further where its pre-tokenizer cuts: runs
of letters, single digits, runs of other characters.  Such a piece is one
pre-token and goes straight to the model, its bytes as the characters that
byte-level vocabularies write for them.  Any other word goes to the tokenizer
as it is.  A piece that a worker has met before needs no second encoding; the
memory of known pieces is two generations, each ended by the batch that takes
it over ``GENERATION`` entries, so it stays bounded over any corpus.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plotcover.llm.common import Words, gather_lists

GENERATION = 100_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN_WORD = f"^[!-&(-~{LETTERS}]+$"            # printable ASCII but the apostrophe
CUT = f"([0-9]|[^0-9{LETTERS} ]+)"
# a piece of a plain word, in lower case
PRE_TOKEN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|(?!.*<\|)[!-&(-/:-@\[-`{-~]+")
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The character that stands for each byte: itself if printable, else one of those from U+0100 on.
BYTE_CHARS = {b: b for b in _PRINTED} | {
    b: 0x100 + n for n, b in enumerate(sorted({*range(0x100)} - {*_PRINTED}))}
_ENCODERS: dict[str, WordEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        new, old, tokenize = self.new, self.old, self.model.tokenize
        out = list(map(new.get, pieces))
        foreign = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            piece = pieces[i]
            ids = old.get(piece)
            if ids is None:
                if PRE_TOKEN.fullmatch(piece):
                    coded = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS)
                    ids = array("I", [t.id for t in tokenize(coded)]).tobytes()
                else:
                    foreign.append(i)
                    continue
            out[i] = new[piece] = ids
        for at in range(0, len(foreign), 4096):
            part = foreign[at:at + 4096]
            coded = self.tokenizer.encode_batch_fast([pieces[i] for i in part],
                                                     add_special_tokens=False)
            for i, c in zip(part, coded):
                out[i] = new[pieces[i]] = array("I", c.ids).tobytes()
        if len(new) > GENERATION:
            self.old, self.new = new, {}
        return out

    def word_ids(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words one after the other, where each word's begin, how many."""
        plain = pc.and_(pc.match_substring_regex(vocabulary, PLAIN_WORD),
                        pc.invert(pc.match_substring(vocabulary, "<|")))
        lower = pc.utf8_lower(vocabulary)
        cut = pc.if_else(plain, pc.replace_substring_regex(lower, CUT, r" \1 "), vocabulary)
        pieces = Words(cut)
        coded = self.piece_ids(pieces.vocabulary.to_numpy(zero_copy_only=False).tolist())
        lens = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat = np.frombuffer(b"".join(coded), np.uint32)
        ids = gather_lists(flat, np.cumsum(lens) - lens, lens, pieces.codes)
        ends = np.concatenate([[0], np.cumsum(lens[pieces.codes])])
        starts = ends[pieces.starts]
        return ids, starts[:-1], np.diff(starts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order (uint32), and where each text's begin
        (one entry more than texts)."""
        words = Words(texts)
        flat, starts, lens = self.word_ids(words.vocabulary)
        ids = gather_lists(flat, starts, lens, words.codes)
        ends = np.concatenate([[0], np.cumsum(lens[words.codes])])
        return ids, ends[words.starts]

    def decode(self, id_lists: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(id_lists, skip_special_tokens=False)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
