"""Token ids of whole texts by the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np

from evenkeel.llm.common import kept_for

STORE = "tokens"  # where a worker keeps its encoders
# Fixed value: the id that ends each document.
END = 0
# A sign that byte-level splitting keeps apart from letters, digits and white space.
APART = "\0"
# White space as the library sees it, and all else: Python counts four separators more.
BLANK, SIGN = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
# Letters and digits of any version of Unicode, for a character class.
ALNUM = "0-9A-Za-zÀ-ÖØ-öø-ɏ"
GROUP_CHARS = 1 << 20  # characters of texts that are split at a time
CHUNK = 256  # pieces that one call of the library gets as one string
ENTRY_BYTES = 200  # what an entry of the store takes beside its signs


class _Known(dict):
    """Ids of pieces, as bytes. A piece that is not known gets an empty buffer, to be filled."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> bytearray:
        self.new.append(piece)
        buffer = self[piece] = bytearray()
        return buffer


class Encoder:
    """``Tokenizer.encode(text, add_special_tokens=False)`` with a store of words.

    The vocabulary's pattern never joins what stands before a run of white space with
    what follows it, so each such piece of a text is encoded once and then looked up.
    Byte-level splitting also parts a letter or digit from the signs behind it: there the
    signs that close a piece are a piece of their own, and many pieces are encoded as one
    string with a sign between them that is a token of its own. The store is emptied once
    it holds more than ``most_bytes``. Texts that hold the string of an added token are encoded as
    a whole.
    """

    def __init__(self, path: str, most_bytes: int = 224 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else None
        self.apart = self._apart()
        # The first branch is the second's commonest case, told quicker.
        closed = "" if self.apart is None else rf" [{ALNUM}]++(?= )|{BLANK}*{SIGN}*[{ALNUM}](?=[{re.escape(string.punctuation)}]*(?:{BLANK}|\Z))|"
        self.pieces = re.compile(rf"{closed}{BLANK}*{SIGN}+|{BLANK}+").findall
        self.joinable = re.compile(rf"(?:{BLANK}|[{ALNUM}])(?:[^{APART}]*[{ALNUM}])?(?<=[{ALNUM}])\Z").match
        self.known = _Known()
        self.most_bytes, self.held = most_bytes, 0

    def _apart(self) -> int | None:
        """The id of ``APART`` if stems may be joined by it, else None."""
        splitter = self.tokenizer.pre_tokenizer
        told = json.loads(splitter.__getstate__()) if splitter else {}
        if told.get("type") != "ByteLevel" or not told.get("use_regex") or told.get("add_prefix_space"):
            return None
        if self.tokenizer.normalizer or self.tokenizer.post_processor:
            return None
        ids = self.tokenizer.encode(APART, add_special_tokens=False).ids
        return ids[0] if len(ids) == 1 else None

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def _joined(self, pieces: list[str]) -> Iterator[bytes]:
        """The ids of ``pieces``, which begin with white space, letter or digit and end with one of the latter."""
        chunks = [pieces[i : i + CHUNK] for i in range(0, len(pieces), CHUNK)]
        found = self.tokenizer.encode_batch_fast(list(map(APART.join, chunks)), add_special_tokens=False)
        for chunk, one in zip(chunks, found, strict=True):
            ids = np.array(one.ids, "<u4")
            ends = (np.flatnonzero(ids == self.apart) * 4).tolist()
            if len(ends) != len(chunk) - 1:
                raise ValueError("a piece was not kept apart from the next")
            data = ids.tobytes()
            yield from map(data.__getitem__, map(slice, [0, *(end + 4 for end in ends)], [*ends, len(data)]))

    def _store(self) -> None:
        """Encode the pieces that were asked for and not known."""
        known, new = self.known, self.known.new
        self.held += sum(map(len, new)) * 3 + len(new) * ENTRY_BYTES
        joined = [] if self.apart is None else list(filter(self.joinable, new))
        whole = list(set(new).difference(joined)) if len(joined) < len(new) else []
        for pieces, encoded in ((joined, list(self._joined(joined))), (whole, self._plain(whole))):
            for piece, ids in zip(pieces, encoded, strict=True):
                known[piece].extend(ids)  # in the texts that wait for it
                known[piece] = ids
        new.clear()

    def batch(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """For each text its ids, then ``END``."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        known, added, pieces = self.known, self.added, self.pieces
        try:
            # A text's pieces are looked up as soon as it is split, while they are at hand.
            found = [None if added and added(text) else list(map(known.__getitem__, pieces(text))) for text in texts]
            self._store()
        except BaseException:
            self._empty()  # of buffers that were not filled
            raise
        if self.held > self.most_bytes:
            self._empty()
        for text, parts in zip(texts, found, strict=True):
            joined = self._plain([text])[0] if parts is None else b"".join(parts)
            out = np.empty(len(joined) // 4 + 1, "<u4")
            out[:-1] = np.frombuffer(joined, "<u4")
            out[-1] = END
            yield out

    def _empty(self) -> None:
        self.known.clear()
        self.known.new.clear()
        self.held = 0

    def ids(self, text: str) -> np.ndarray:
        """The ids of ``text``, then ``END``."""
        return next(self.batch([text]))


def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that tasks share its store."""
    encoders = kept_for(STORE)
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
