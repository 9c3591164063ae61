"""Token ids of whole texts, as the tokenizers library gives them.

The word vocabulary drops white space and never joins letters across it, so
a text's ids are the ids of its words in turn.  Words repeat; each task keeps
the ids of the words it has met (up to ``MAX_WORDS``) and hands the library
only new ones.  A closing run of punctuation after a letter is a word part of
its own, as the vocabulary's splitting pattern also breaks there.  Texts that
hold the opening of a special token go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np

from starmart.llm.common import LOWER, span_hashes, words

END_ID = 2
#: Words of which a Python worker keeps the ids; beyond it the store is begun anew.
MAX_WORDS = 1_000_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_POINT = np.zeros(256, dtype=bool)                       # ASCII punctuation without the apostrophe
_POINT[33:39] = _POINT[40:48] = _POINT[58:65] = _POINT[91:97] = _POINT[123:127] = True
_encoders: dict[str, "Encoder"] = {}


def tokenizer_path() -> str:
    """The default vocabulary; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.closes[i] = token.endswith("</w>")
        self.max_words = max_words
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store, self.used = np.zeros(1 << 16, np.int32), 0

    def _library_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in turn, and how many each has.

        Parts of letters only go in joined by blanks: each ends in one closing token.
        """
        plain = [i for i, p in enumerate(parts) if p.isalpha()]
        rest = sorted(set(range(len(parts))).difference(plain))
        pieces, owners = [], []
        for k in range(0, len(plain), 8192):
            some = plain[k:k + 8192]
            text = " ".join([parts[i] for i in some])
            ids = np.asarray(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            closing = self.closes[ids]
            if int(closing.sum()) == len(some) and len(ids) and closing[-1]:
                pieces.append(ids)
                owners.append(np.asarray(some)[np.cumsum(closing) - closing])
            else:
                rest += some
        for i, x in zip(rest, self.library.encode_batch_fast([parts[i] for i in rest], add_special_tokens=False)):
            pieces.append(np.asarray(x.ids, np.int32))
            owners.append(np.full(len(x.ids), i))
        ids = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
        owner = np.concatenate(owners).astype(np.int64) if owners else np.zeros(0, np.int64)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(parts)).astype(np.int64)

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        ids, size = self._library_ids(parts)
        need = self.used + len(ids)
        if need > len(self.store):
            self.store = np.resize(self.store, max(need, 2 * len(self.store)))
        self.store[self.used:need] = ids
        at = self.used + np.cumsum(size) - size
        self.used = need
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = np.insert(self.keys, place, keys), np.insert(self.at, place, at), np.insert(self.size, place, size)

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn (the end id after each) and the number of ids of each text."""
        n = len(offs) - 1
        marks = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124)) if len(raw) > 1 else np.zeros(0, np.int64)
        whole = np.unique(np.searchsorted(offs[1:], marks, side="right"))
        starts, ends, doc = words(raw, offs)
        if len(whole):
            keep = ~np.isin(doc, whole)
            starts, ends, doc = starts[keep], ends[keep], doc[keep]
        ids, sizes, counts = self._by_words(raw, starts, ends, doc, n)
        # the place of each text's ids, with room for the end id
        special = {int(d): np.asarray(self.library.encode(raw[offs[d]:offs[d + 1]].tobytes().decode(), add_special_tokens=False).ids, np.int32) for d in whole}
        for d, x in special.items():
            counts[d] = len(x)
        counts += 1
        first = np.cumsum(counts) - counts
        out = np.full(int(counts.sum()), END_ID, dtype=np.int32)
        seen = np.zeros(len(out), dtype=bool)
        seen[first + counts - 1] = True
        for d, x in special.items():
            out[first[d]:first[d] + len(x)] = x
            seen[first[d]:first[d] + len(x)] = True
        out[~seen] = ids
        return out, counts

    def _by_words(self, raw, starts, ends, doc, n):
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(n, np.int64)
        # letters A-Z may be lowered beforehand only in words of ASCII
        low = LOWER[raw]
        foreign = np.flatnonzero(np.logical_or.reduceat(raw >= 128, starts))
        if len(foreign):
            size = (ends - starts)[foreign]
            kept = np.repeat(starts[foreign] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            low[kept] = raw[kept]
        # a closing run of up to eight marks after a letter is a part of its own
        place = np.flatnonzero(_POINT[raw[ends - 1]] & (ends - starts > 1))
        cuts, begin = ends[place] - 1, starts[place]
        for _ in range(7):
            cuts = cuts - (_POINT[raw[cuts - 1]] & (cuts - 1 > begin))
        latin = (cuts - 2 >= begin) & (raw[np.maximum(cuts - 2, 0)] == 0xC3) & (raw[cuts - 1] >= 128) & ~np.isin(raw[cuts - 1], (0x97, 0xB7))
        split = _LETTER[raw[cuts - 1]] | latin
        place, cuts = place[split], cuts[split]
        starts, ends, doc = np.insert(starts, place + 1, cuts), np.insert(ends, place, cuts), np.insert(doc, place + 1, doc[place])

        keys, first, inverse = np.unique(span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.max_words and len(self.keys):
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            data = low.tobytes()
            new = first[~known]
            self._learn(keys[~known], [data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        size = self.size[at][inverse]
        begin = self.at[at][inverse]
        total = int(size.sum())
        ids = self.store[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)]
        counts = np.bincount(doc, weights=size, minlength=n).astype(np.int64)
        return ids, size, counts
