"""Whole texts to token ids with a public ``tokenizers`` file, each distinct piece encoded once.

A BPE file encodes the pieces of its pre-tokenizer one by one, so ids of a text are those of its
pieces, joined. Texts of plain characters are cut at places that are always piece ends, and a piece
seen before is looked up. A new word goes through the library's BPE model, any other new piece and
any text that cannot be cut safely through the whole library. All three give the library's ids.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cargoloom.llm.common import taken

# Characters whose class is the same for every regular-expression library: no superscript and
# fraction digits, no combining marks, no control characters but tab and line ends;
# nor the dotted capital I, which lower-cases to a letter and a mark.
_ODD_CHARACTER = "[^\t\n\r\x20-\x7e¡-±´-¸º»¿-įı-ɏ‐-‧]"
# Where a cut before a space, stop, comma or line end need not be a piece end, among simple pieces...
_ODD_PAIR = {"byte": r"\n[ \n.,]|[.,][.,]", "word": "[.,][.,]"}
# ... and in texts that hold other pieces as well; these texts have no letters, digits and white space but simple ones.
_ODD_PLACE = {"byte": r"[\t\n\r ]{2}|[^\pL0-9\n][.,]", "word": r"[^\pL0-9\t\n\r ][.,]"}
# How the pre-tokenizer of the word file cuts a piece without an apostrophe: letters, single digits, runs of other characters.
_PARTS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE files write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


class PieceEncoder(dict):
    """``encode(texts)`` gives each text's ids; as a dictionary it holds the ids of pieces, as bytes.

    ``style`` is ``byte`` (byte-level BPE, a space belongs to the word behind it) or ``word`` (BPE with word
    ends, lower case, spaces dropped). A special token's string in a text is that token, as the library has it. Pieces take
    some ``most`` bytes: beyond half of that a new memory is begun between batches, and the one before it is kept for pieces that come again.
    """

    def __init__(self, path: str, style: str, most: int = 128 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        # What all special tokens begin with: few texts have it.
        self.mark = os.path.commonprefix(self.special)
        self.style, self.most, self.size, self.letters, self.other = style, most, 0, byte_letters(), set()
        self.older: dict[str, bytes] = {}
        self.older_other: set[str] = set()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.pop(piece, None)
        if ids is None:
            ids = self._new(piece)
        elif piece in self.older_other:
            self.other.add(piece)
        self[piece] = ids
        self.size += 200 + 2 * len(piece) + len(ids)  # what a string, its bytes and their place take, nearly
        return ids

    def _new(self, piece: str) -> bytes:
        spaced = self.style == "byte" and piece[:1] == " "
        word = piece[1:] if spaced else piece
        if word.isalpha():
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            tokens = self.model.tokenize(self.letters[32] + shown if spaced else shown)
            ids = array(self.kind.char, [t.id for t in tokens]).tobytes()
        else:
            if piece not in ("", ".", ",", "\n"):
                self.other.add(piece)
            parts = _PARTS.findall(piece) if self.style == "word" and "'" not in piece else []
            ids = b"".join(map(self.__getitem__, parts)) if len(parts) > 1 else self.whole(piece).tobytes()
        return ids

    def _special(self, texts: pa.Array) -> list[pa.Array]:
        """For each special token which texts hold its string; nothing if no text holds even what all begin with."""
        if self.mark and not pc.any(pc.match_substring(texts, self.mark), min_count=0).as_py():
            return []
        return [pc.match_substring(texts, t) for t in self.special]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Each text's ids (null: empty). Texts of simple characters are cut all at once, and each distinct piece of them looked up once."""
        texts = pc.fill_null(texts, "")
        lower = pc.utf8_lower(texts) if self.style == "word" else texts
        whole = pc.match_substring_regex(texts, _ODD_CHARACTER)
        for odd in (pc.match_substring_regex(texts, _ODD_PAIR[self.style]), *self._special(lower)):
            # In capitals a special token's string is ordinary text, but its lower-cased pieces would not be.
            whole = pc.or_(whole, odd)
        out: list[np.ndarray] = [np.zeros(0, self.kind)] * len(texts)
        simple = lower.filter(pc.invert(whole))
        if self.style == "word":
            lists = pc.ascii_split_whitespace(pc.replace_substring(pc.replace_substring(simple, ".", " ."), ",", " ,"))
        else:
            for mark in (" ", ".", ",", "\n"):
                simple = pc.replace_substring(simple, mark, "\x01" + mark + ("\x01" if mark == "\n" else ""))
            lists = pc.split_pattern(simple, "\x01")
        places = np.flatnonzero(pc.invert(whole).to_numpy(zero_copy_only=False))
        if len(places):
            coded = pc.dictionary_encode(lists.flatten())
            pieces, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
            if self.size > self.most // 2:
                self.older, self.older_other = dict(self), self.other
                self.clear()
                self.other, self.size = set(), 0
            ids = list(map(self.__getitem__, pieces))
            flat, n = taken(np.frombuffer(b"".join(ids), self.kind), np.array(list(map(len, ids))) // self.kind.itemsize, numbers)
            in_text = pc.list_value_length(lists).to_numpy()
            ends = np.cumsum(in_text)
            cut = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], ends))].tolist()
            # Where pieces that are no words come in, a cut need not have been a piece's end.
            other = np.fromiter(map(self.other.__contains__, pieces), bool, len(pieces))[numbers]
            some = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(other)))[ends], prepend=0))
            for i, place in enumerate(places.tolist()):
                out[place] = flat[cut[i] : cut[i + 1]]
            odd = texts.take(pa.array(places[some]))
            odd = pc.match_substring_regex(odd, _ODD_PLACE[self.style]).to_numpy(zero_copy_only=False).astype(bool)
            for place in places[some[odd]].tolist():
                out[place] = self.whole(texts[place].as_py())
        for place in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[place] = self.whole(texts[place].as_py())
        return out


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, style: str) -> PieceEncoder:
    """The encoder of a file; a Python worker that runs several tasks keeps it, with its pieces."""
    if (path, style) not in _encoders:
        _encoders[path, style] = PieceEncoder(path, style)
    return _encoders[path, style]
