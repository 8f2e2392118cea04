"""Token ids by a public tokenizer's vocabulary, through remembered pieces.

Both vocabularies split a text at white space before they merge, so a text's ids are
those of its pieces, one after the other. A batch is cut at spaces and line ends and its
pieces are numbered, all in Arrow; only pieces that the worker has not met yet go through
the tokenizer, many in one call; the ids of all texts are then gathered in one step. What
is remembered is bounded: where it grows too much, the pieces met least go. Texts in which such a cut could matter are encoded whole.
"""

from __future__ import annotations

import gc
import string

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from changefeed.llm.common import give_back

REMEMBERED = 900_000
# Texts whose pieces are numbered together.
TEXTS = 2_000
# With two white spaces in a row, byte-level tokens may span a cut between them.
DOUBLE = r"[\t-\r\x{85}\p{Z}]{2}"
# Letters, numbers and ASCII signs but "<": one part between two marks.
SIMPLE = r"[\p{L}\p{N}!-;=-~]+$"
_LOADED: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """``kind``: "byte" keeps white space in its tokens, "word" drops it."""

    def __init__(self, path: str, kind: str) -> None:
        if kind not in ("byte", "word"):
            raise ValueError(f"unknown kind of vocabulary: {kind}")
        self.tokenizer = Tokenizer.from_file(path)
        self.byte = kind == "byte"
        # Between pieces stands a mark that is always one token of its own.
        self.mark = "\n" if self.byte else " \x01 "
        [self.mark_id] = self.whole(self.mark)
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.first, self.length = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32)
        # In how many calls a piece was met since it was learned or last kept.
        self.met = np.zeros(1 << 18, np.int32)

    def forget_rare(self) -> None:
        """Keep the pieces met most often, half of ``REMEMBERED`` at most."""
        met, pieces = self.met[: len(self.slot)], list(self.slot)
        least = 2
        while np.count_nonzero(met >= least) > REMEMBERED // 2:
            least *= 2
        kept = np.flatnonzero(met >= least)
        first, length = self.first[kept], self.length[kept].astype(np.int64)
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(first - (ends - length), length) + np.arange(total)]
        self.forget()
        self._store([pieces[i] for i in kept.tolist()], ids, length)

    def whole(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, np.uint32)

    def learn(self, new: pa.StringArray) -> None:
        """Remember the ids of pieces.

        A piece follows a space unless it starts with a line end, which is a token of its
        own. Between a letter and the ASCII punctuation after it both vocabularies cut, so
        the parts before and after are encoded once each, whatever pieces they are in.
        """
        lined = np.zeros(len(new), bool)
        text = new
        if self.byte:
            lined = pc.starts_with(new, "\n").to_numpy(zero_copy_only=False)
            text = pc.if_else(
                pa.array(lined), pc.utf8_slice_codeunits(new, 1), pc.binary_join_element_wise(" ", new, "")
            )
        base = pc.utf8_rtrim(text, string.punctuation)
        whole = pc.or_(pc.match_substring(text, "<"), pc.invert(pc.match_substring_regex(base, r"\p{L}$")))
        base = pc.if_else(whole, text, base)
        cut = pc.utf8_length(base).to_numpy(zero_copy_only=False)
        longer = np.flatnonzero(cut < pc.utf8_length(text).to_numpy(zero_copy_only=False))
        tails = [t[c:] for t, c in zip(text.take(pa.array(longer)).to_pylist(), cut[longer].tolist(), strict=True)]
        coded = pa.concat_arrays([base.cast(pa.string()), pa.array(tails, pa.string())]).dictionary_encode()
        ids, first, length = self._encoded(coded.dictionary)
        number = coded.indices.to_numpy(zero_copy_only=False)
        # A piece is up to three parts: the line end, the base, the punctuation.
        parts = np.zeros((len(new), 3, 2), np.int64)
        parts[lined, 0] = (len(ids), 1)
        of = number[: len(new)]
        parts[:, 1, 0], parts[:, 1, 1] = first[of], length[of]
        of = number[len(new) :]
        parts[longer, 2, 0], parts[longer, 2, 1] = first[of], length[of]
        ids = np.append(ids, np.uint32(self.mark_id))
        starts, lengths = parts[:, :, 0].ravel(), parts[:, :, 1].ravel()
        ends = np.cumsum(lengths)
        joined = ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]
        self._store(new.to_pylist(), joined, parts[:, :, 1].sum(axis=1))

    def _encoded(self, coded: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all parts, and where each one's begin and how many they are."""
        parts = coded.to_pylist()
        simple = pc.match_substring_regex(coded, ("^ ?" if self.byte else "^") + SIMPLE)
        simple = simple.to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(simple).tolist()
        for i in np.flatnonzero(~simple).tolist():
            text = parts[i][1:] if self.byte and parts[i][:1] == " " else parts[i]
            # Others, among them the names of special tokens, go one by one.
            if text and text.isprintable() and " " not in text and "<" not in text and not text.isspace():
                plain.append(i)
        length = np.zeros(len(parts), np.int64)
        first = np.zeros(len(parts), np.int64)
        ids = self.whole(self.mark.join([parts[i] for i in plain])) if plain else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.mark_id)
        if plain and len(ends) == len(plain) - 1:
            edges = np.concatenate([[-1], ends, [len(ids)]])
            first[plain], length[plain] = edges[:-1] + 1, np.diff(edges) - 1
            others = sorted(set(range(len(parts))).difference(plain))
        else:
            others, ids = range(len(parts)), np.zeros(0, np.uint32)
        rest, at = [ids], len(ids)
        for i in others:
            found = self.whole(parts[i]) if parts[i] else np.zeros(0, np.uint32)
            first[i], length[i] = at, len(found)
            at += len(found)
            rest.append(found)
        return np.concatenate(rest), first, length

    def _store(self, pieces: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        at, end = len(self.slot), len(self.slot) + len(pieces)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while end > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[at:end] = self.used + np.cumsum(length) - length
        self.length[at:end] = length
        self.met[at:end] = 1
        self.slot.update(zip(pieces, range(at, end), strict=True))
        self.used += len(ids)

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        if self.byte:
            # The first piece gets a line end too; its token is dropped again.
            lined = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
            return pc.split_pattern(lined, " ")
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def __call__(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin and end; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        collecting = gc.isenabled()
        gc.disable()  # millions of strings, none in a cycle
        found = [self._some(texts.slice(at, TEXTS), end_id) for at in range(0, len(texts), TEXTS)]
        if collecting:
            gc.enable()
        give_back()  # new pieces leave more behind than is remembered of them
        ids = np.concatenate([i for i, _ in found] or [np.zeros(0, np.uint32)])
        edges = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in found] or [np.zeros(0, np.int64)]))])
        return ids, edges

    def _some(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        apart = np.zeros(len(texts), bool)
        if self.byte:
            apart = pc.match_substring_regex(texts, DOUBLE).to_numpy(zero_copy_only=False)
        if apart.any():
            parts = []
            for i, text in enumerate(texts.to_pylist()):
                if apart[i]:
                    parts.append(self.whole(text))
                else:
                    parts.append(self._gathered(texts.slice(i, 1), None)[0])
            if end_id is not None:
                parts = [np.append(p, np.uint32(end_id)) for p in parts]
            return np.concatenate(parts).astype(np.uint32), np.array([len(p) for p in parts], np.int64)
        return self._gathered(texts, end_id)

    def _gathered(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        lists = self._cut(texts)
        coded = lists.flatten().dictionary_encode()
        unique, number = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        if len(self.slot) > REMEMBERED:
            self.forget_rare()
        found = np.array([self.slot.get(p, -1) for p in unique], np.int64)
        self.met[found[found >= 0]] += 1
        if len(new := np.flatnonzero(found < 0)):
            found[new] = len(self.slot) + np.arange(len(new))
            self.learn(coded.dictionary.take(pa.array(new)))
        slots = found[number]
        first, length = self.first[slots], self.length[slots].astype(np.int64)
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        if self.byte:  # without the token of the line end put before each text
            first[edges[:-1]] += 1
            length[edges[:-1]] -= 1
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(first - (ends - length), length) + np.arange(total)
        ids = self.ids[take]
        until = np.concatenate([[0], ends])[edges]
        if end_id is None:
            return ids, np.diff(until)
        ids = np.insert(ids, until[1:], np.uint32(end_id))
        return ids, np.diff(until) + 1


def encoder(name: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file, given by name or path."""
    path = name if "/" in name else public_tokenizers.path(name)
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = Encoder(path, kind)
    return _LOADED[path, kind]
