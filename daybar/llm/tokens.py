"""Token ids of texts, by the tokenizers library over distinct pieces."""

from __future__ import annotations

import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 1_000_000  # in each of two generations of pieces that a worker remembers: some 400 MB in all
_models: dict[str, _Model] = {}

# A single space between two other characters always begins a piece of a byte-level BPE's pre-tokenizer
# (" ?letters", " ?digits", " ?others"), so what lies between such spaces is encoded alike anywhere.
_GAP = re.compile(r"(?<=\S) (?=\S)")
# All white space but the space and the newline.
_OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_BREAKS = ("  ", "\n\n", " \n", "\n ", *_OTHER_SPACE)
# Marks at the end of a word form a piece of their own behind a letter.
_MARKS = ".,!?;:*$%&#|"
# Letters below this are letters to every Unicode version: a run of them is one piece.
_PLAIN = "ɐ"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Ids of pieces that follow ``lead``; an unknown one is encoded as it is asked for."""

    def __init__(self, model: _Model, lead: str, older: dict):
        self.model, self.lead, self.older = model, lead, older

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(_MARKS)
            if core != word and core[-1:].isalpha():
                ids = self[core] + self.model.first[word[len(core):]]
            elif word.isalpha() and (word.isascii() or max(word) < _PLAIN):
                ids = self.model.letters(self.lead, word)
            else:
                ids = self.model.whole(self.lead + word)
        self[word] = ids
        return ids


class _Model:
    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bpe = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(ord(_PLAIN))}
        self.leads = {"": "", " ": self.byte_level[ord(" ")]}
        # The same BPE model over many pieces at once, cut where a leading space says so.
        self.many = Tokenizer(self.bpe)
        self.many.pre_tokenizer = pre_tokenizers.Split(self.leads[" "], "merged_with_next")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that only a piece's first token can have
        self.begins[[i for t, i in vocabulary.items() if t.startswith(self.leads[" "])]] = True
        self.inner, self.first = _Pieces(self, " ", {}), _Pieces(self, "", {})

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, lead: str, word: str) -> bytes:
        """A piece that the pre-tokenizer leaves whole, straight through the library's BPE model."""
        if not word.isascii():  # ASCII letters stand for themselves
            word = word.translate(self.byte_level)
        return array("I", [t.id for t in self.bpe.tokenize(self.leads[lead] + word)]).tobytes()

    def letters_of(self, words: list[str]) -> list[bytes]:
        """``letters`` of different words behind a space, in one call of the library."""
        lead = self.leads[" "]
        pieces = [lead + (w if w.isascii() else w.translate(self.byte_level)) for w in words]
        coded = self.many.encode_batch_fast(["".join(pieces[i:i + 50]) for i in range(0, len(pieces), 50)], add_special_tokens=False)
        flat = np.array([i for e in coded for i in e.ids], np.uint32)
        ends, data = (4 * np.append(np.flatnonzero(self.begins[flat]), len(flat))).tolist(), flat.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of different words, each behind a space; new ones of letters are encoded together."""
        inner, older, first = self.inner, self.inner.older, self.first
        cores = list(map(str.rstrip, words, repeat(_MARKS)))
        ids = list(map(inner.get, cores))
        new, at = {}, []
        for k in [k for k, x in enumerate(ids) if x is None]:
            core = cores[k]
            if core.isalpha() and (core.isascii() or max(core) < _PLAIN) and core not in older:
                new[core] = None
                at.append(k)
            elif core == words[k] or core[-1:].isalpha():
                ids[k] = inner[core]
        inner.update(zip(new, self.letters_of(list(new)), strict=True))
        for k in at:
            ids[k] = inner[cores[k]]
        for k in [k for k, (core, word) in enumerate(zip(cores, words)) if core != word]:
            core, word = cores[k], words[k]
            ids[k] = ids[k] + first[word[len(core):]] if core[-1:].isalpha() else inner[word]
        return ids

    def pieces(self) -> tuple[_Pieces, _Pieces]:
        """The memories; a full one becomes the older generation, of which only what is asked for again stays."""
        for name in ("inner", "first"):
            full = getattr(self, name)
            if len(full) > CACHE_PIECES:
                full.older = {}
                setattr(self, name, _Pieces(self, full.lead, full))
        return self.inner, self.first


def encode(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers.

    Texts fall into pieces that the pre-tokenizer treats alone; a piece is
    encoded once while the worker remembers it, and looked up once in a call.
    The pieces' ids in order are those of the whole text. A text that
    holds an added token's string is encoded whole, and that string is the token.
    """
    if path not in _models:
        _models[path] = _Model(path)
    model = _models[path]
    inner, _ = model.pieces()
    of, out, plain = inner.__getitem__, [b""] * len(texts), []
    for i, text in enumerate(texts):
        if any(token in text for token in model.added):
            out[i] = model.whole(text)
        # Where every white space is a single space or newline inside the text, lines are cut too (a newline
        # between other characters is a piece); else only spaces that stand alone.
        elif text[:1].strip() and text[-1:].strip() and not any(x in text for x in _BREAKS):
            plain.append(i)
        else:
            words = _GAP.split(text)
            out[i] = model.whole(words[0]) + b"".join(map(of, words[1:]))
    for i, ids in zip(plain, _plain([texts[i] for i in plain], model)):
        out[i] = ids
    return out


def _plain(texts: list[str], model: _Model) -> list[bytes]:
    """Ids of texts that are words with a single space or newline between any two."""
    if not texts:
        return []
    # Words behind a space as they are, those that begin a text or line behind a mark that no such text holds.
    cut = pc.split_pattern(pa.array(["\r" + t.replace("\n", " \n\r") for t in texts], pa.large_string()), " ")
    coded = cut.flatten().dictionary_encode()
    different = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
    words = pc.binary_join(different, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
    begins = np.flatnonzero(pc.match_substring(coded.dictionary, "\r").to_numpy(zero_copy_only=False)).tolist()
    firsts = {k: words[k].partition("\r") for k in begins}
    for k in begins:
        words[k] = ""
    ids = model.of_words(words)
    for k, (newline, _, word) in firsts.items():
        ids[k] = model.first[newline] + model.first[word]
    taken = pa.array(ids, pa.large_binary()).take(coded.indices)
    at = np.frombuffer(taken.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist()
    data = memoryview(taken.buffers()[2])
    return [bytes(data[a:b]) for a, b in zip(at, at[1:])]
