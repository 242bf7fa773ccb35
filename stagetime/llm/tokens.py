"""Byte-level BPE encoding in Spark tasks, with a bounded memory of words already encoded.

The vocabulary's pre-tokeniser never joins what stands on either side of a single space: a space that
has no white space beside it opens a new unit.  So a text in which all white space stands alone is the
sequence of its words, each with the space before it, and equal words have equal ids.  All ids come from
the tokenizers library; texts with adjoining white space are encoded whole, and so are all texts where the
vocabulary's own description names another normaliser, pre-tokeniser or model.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: White space other than the space and the line feed, as either Python or the pre-tokeniser sees it.
_OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ADJOINING = ("  ", "\n\n", " \n", "\n ")
_MARKED = re.compile(r"([^\W\d_]+)([^\w\s]+)")


class TextEncoder:
    """encode(texts) gives, for each, the ids of Tokenizer.encode(text, add_special_tokens=False).

    most_words bounds the words remembered between calls; a word of over 40 characters isn't.
    """

    def __init__(self, path: str, most_words: int = 900_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole_only = [*(t.content for t in self.tokenizer.get_added_tokens_decoder().values()), *_ADJOINING, *_OTHER_SPACE]
        self.by_words = self._splits_at_spaces()
        self.most_words = most_words
        self.newline = self.whole("\n")
        #: Ids of a word after a space; of one that begins with a line feed, with the line feed.
        self.known: dict[str, bytes] = {"": self.whole(" "), "\n": self.newline}
        self.marks: dict[str, bytes] = {}

    def _splits_at_spaces(self) -> bool:
        """Whether the vocabulary is of the kind that the module's first lines describe."""
        says = json.loads(self.tokenizer.to_str())
        before, model = says.get("pre_tokenizer") or {}, says["model"]
        plain = not any(says.get(k) for k in ("normalizer", "truncation", "padding"))
        bytewise = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        return plain and bytewise and model.get("type") == "BPE" and not model.get("dropout")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: list[str], before: str) -> list[bytes]:
        """Ids of words of letters only with a space or a line feed before each."""
        got = self.tokenizer.encode(before + before.join(words), add_special_tokens=False)
        units = 1 if before == " " else 2
        unit, ids = np.array(got.word_ids), np.array(got.ids, "<u4").tobytes()
        if unit[-1] != len(words) * units - 1:
            return [self.whole(before + w) for w in words]
        cut = (np.searchsorted(unit, np.arange(0, len(words) * units + 1, units)) * 4).tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def _learn(self, words: set[str]) -> None:
        known, marks = self.known, self.marks
        plain = {w for w in words if w.isalpha()}
        first, marked = set(), []
        for word in words.difference(plain):
            opens = word[0] == "\n"
            w = word[1:] if opens else word
            if opens and w.isalpha():
                first.add(w)
            elif (m := _MARKED.fullmatch(w)) and m[1].isalpha():
                base, mark = m.groups()
                marked.append((word, "\n" + base if opens else base, mark))
                (first if opens else plain).add(base)
            else:
                known[word] = self.whole(word if opens else " " + word)
        for before, key, some in ((" ", "", plain), ("\n", "\n", first)):
            todo = [w for w in some if key + w not in known]
            for at in range(0, len(todo), 1000):
                part = todo[at : at + 1000]
                known.update(zip([key + w for w in part] if key else part, self._letters(part, before), strict=True))
        for word, base, mark in marked:
            if mark not in marks:
                marks[mark] = self.whole(mark)
            known[word] = known[base] + marks[mark]

    def encode(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, each text's with end after them."""
        out: list[bytes] = [end] * len(texts)
        split, new, skip, size = [], set(), len(self.newline), len(self.known)
        look = self.known.get
        for at, text in enumerate(texts):
            if not self.by_words or any(x in text for x in self.whole_only):
                out[at] = self.whole(text) + end
            elif text:
                words = f"\n{text}".replace("\n", " \n").split(" ")
                del words[0]
                ids = list(map(look, words))
                gaps = [i for i, x in enumerate(ids) if x is None] if None in ids else []
                new.update([words[i] for i in gaps])
                split.append((at, words if gaps else None, ids, gaps))
        if new:
            self._learn(new)
        for at, words, ids, gaps in split:
            for i in gaps:
                ids[i] = look(words[i])
            ids[0] = ids[0][skip:]
            ids.append(end)
            out[at] = b"".join(ids)
        if len(self.known) > self.most_words:  # what is new since goes, newest first
            for _ in range(len(self.known) - max(size, self.most_words)):
                self.known.popitem()
        if len(self.marks) > 10_000:
            self.marks.clear()
        for w in new:
            if len(w) > 40:
                self.known.pop(w, None)
        return out


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each vocabulary file and Python worker."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
