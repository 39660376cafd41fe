"""Token ids of whole texts by the tokenizers library, in Arrow batches inside tasks."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that the tokenizers' patterns, Python and Arrow don't treat alike.
ODD_SPACE = "[" + "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]"
#: Also spaces that don't stand alone between two non-blanks.
WIDE_SPACE = ODD_SPACE + r"|[ \t-\r] | [ \t-\r]|^ | $"
_CHUNK = re.compile(r"\s*\S+|\s+", re.ASCII)
#: Marks that may follow a word.
_TAIL = ".,;:!?"
#: A word of Latin letters that are composed and have one lower case, and marks after it.
_WORD = re.compile(r"([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+)([!-/:-@\[-`{-~]*)").fullmatch
#: How vocabularies of bytes spell those bytes that aren't spelt by the character of their number.
_SPELT = {b: chr(256 + i) for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
#: Texts that are encoded at once.
ROWS = 2500
#: Pieces of up to LONGEST characters are remembered: the last MOST or more, and those before them.
LONGEST, MOST = 64, 250_000


class Encoder:
    """Encodes batches of texts, and remembers the ids of pieces that end before white space.

    The vocabularies here split a text with a pattern whose matches never run from a non-blank into a blank, so the ids of a
    text are those of its pieces, one after another. A batch's distinct pieces are looked up, new ones are encoded by the
    library, and the texts' ids are gathered from them; that spares most merges. With `words`, white space has no ids
    (word_bpe_49k); else it belongs to the piece it precedes (byte_bpe_50k). Texts in which the rules for white space could
    differ are cut elsewhere or, if need be, not at all. Strings of special tokens in a text become those tokens, as by the
    library's default; with `escape` they are ordinary text, so that a text can't inject them.
    """

    def __init__(self, file: str, words: bool, escape: bool = False, memo: int = MOST):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = escape
        # strings that the library looks for before it splits a text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (escape and t.special)]
        self.added = "|".join(map(re.escape, sorted(added)))
        self._added = re.compile(self.added, re.IGNORECASE).search
        self.words, self.memo = words, memo
        self.new: dict[str, np.ndarray] = {}
        self.old: dict[str, np.ndarray] = {}

    def _encode(self, pieces: list[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encode(pieces, add_special_tokens=False)]

    def _word_ids(self, pieces: list[str]) -> list[bytes]:
        """_ids with `words`: a Latin word is one match in lower case, so the library's model gets it straight away, and marks after it start a match of their own."""
        new, old, merge, added = self.new, self.old, self.tokenizer.model.tokenize, self.added and self._added

        def known(part: str, word: bool) -> bytes:
            if (ids := new.get(part)) is None:
                if (ids := old.get(part)) is None:
                    spelt = part if part.isascii() else part.encode().decode("latin-1").translate(_SPELT)
                    ids = array("I", [t.id for t in merge(spelt)]).tobytes() if word else self._encode([part])[0]
                if len(part) <= LONGEST:
                    new[part] = ids
            return ids

        found: list[bytes | None] = []
        rest: dict[str, bytes] = {}
        for p in pieces:
            ids = new.get(p)
            if ids is None:
                if (m := _WORD(p)) and not (added and added(p)):
                    ids = known(m[1].lower(), True)
                    if m[2]:
                        ids += known(m[2], False)
                elif (ids := old.get(p)) is not None:
                    new[p] = ids
                else:
                    rest[p] = b""
            found.append(ids)
        order = list(rest)
        for k in range(0, len(order), 10_000):
            some = order[k : k + 10_000]
            rest.update(zip(some, self._encode(some), strict=True))
        new.update((p, ids) for p, ids in rest.items() if len(p) <= LONGEST)
        return [rest[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)] if rest else found

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; those that weren't used since the memo last filled up are forgotten."""
        if len(self.new) > self.memo:
            self.old, self.new = self.new, {}
        if self.words:
            return self._word_ids(pieces)
        new, old = self.new, self.old
        unseen: dict[str, None] = {}
        whole: list[tuple[str, str, str]] = []
        for p in pieces:
            if p in new:
                continue
            if p in old:
                new[p] = old[p]
                continue
            stem = p.rstrip(_TAIL)
            if stem and stem[-1].isalpha() and len(stem) < len(p) and not (self.added and self._added(p)):
                # a mark after a letter starts a match of its own, so the ids are those of the parts
                tail = p[len(stem) :]
                whole.append((p, stem, tail))
                for part in (stem, tail):
                    if part not in new:
                        if part in old:
                            new[part] = old[part]
                        else:
                            unseen[part] = None
            else:
                unseen[p] = None
        once: dict[str, bytes] = {}
        order = list(unseen)
        for k in range(0, len(order), 10_000):
            some = order[k : k + 10_000]
            for p, ids in zip(some, self._encode(some), strict=True):
                (new if len(p) <= LONGEST else once)[p] = ids
        get = lambda p: new[p] if p in new else once[p]
        for p, stem, tail in whole:
            (new if len(p) <= LONGEST else once)[p] = get(stem) + get(tail)
        return [get(p) for p in pieces] if once else [new[p] for p in pieces]

    def holds_added(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold the string of an added token; these are encoded whole."""
        if not self.added:
            return np.zeros(len(texts), dtype=bool)
        return pc.match_substring_regex(texts, self.added, ignore_case=True).to_numpy(zero_copy_only=False)

    def _cut(self, texts: pa.Array) -> pa.Array:
        """The pieces of each text, as lists."""
        if self.words:
            return pc.ascii_split_whitespace(texts)
        cut = pc.split_pattern(texts, " ")
        offsets, flat = cut.offsets.to_numpy(), cut.flatten()
        first = np.zeros(len(flat), dtype=bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        spaced = pc.if_else(pa.array(first), flat, pc.binary_join_element_wise(pa.scalar(""), flat, " "))
        return pa.ListArray.from_arrays(cut.offsets, spaced)

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, end_id after each, and where each text's ids start and the last end. Null counts as empty."""
        done = [self._some(texts.slice(k, ROWS), end_id) for k in range(0, len(texts), ROWS)]
        if len(done) == 1:
            return done[0]
        ids = np.concatenate([np.zeros(0, dtype=np.uint32), *(d[0] for d in done)])
        starts = np.cumsum([0, *(len(d[0]) for d in done)])
        return ids, np.concatenate([np.zeros(1, dtype=np.int64), *(d[1][1:] + s for d, s in zip(done, starts, strict=False))])

    def _some(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, ODD_SPACE if self.words else WIDE_SPACE).to_numpy(zero_copy_only=False)
        held = self.holds_added(texts)
        odd = odd | held
        lists = self._cut(pc.if_else(pa.array(odd), "", texts))
        offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
        if odd.any():
            pieces, cut, last = [], [], 0
            for i in np.flatnonzero(odd):
                text = texts[int(i)].as_py()
                own = [text] if held[i] or re.search(ODD_SPACE, text) else _CHUNK.findall(text)
                cut += [flat.slice(last, offsets[i] - last), pa.array(own, pa.string())]
                last = offsets[i + 1]
                pieces.append((i, len(own) - (offsets[i + 1] - offsets[i])))
            flat = pa.concat_arrays([*cut, flat.slice(last)])
            more = np.zeros(len(texts), dtype=np.int64)
            for i, n in pieces:
                more[i] = n
            offsets = offsets + np.concatenate([[0], np.cumsum(more)])
        coded = flat.dictionary_encode()
        known = self._ids(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        pool, starts = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy()
        taken = lengths[at]
        ends = np.cumsum(taken)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(starts[at] - (ends - taken), taken) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[offsets]
        return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))


_encoders: dict[tuple[str, bool, bool, int], Encoder] = {}


def encoder(file: str, words: bool, escape: bool = False, memo: int = MOST) -> Encoder:
    """One for each Python worker."""
    key = (file, words, escape, memo)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]
