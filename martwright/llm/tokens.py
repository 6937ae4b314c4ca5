"""Token ids of whole texts, in Arrow batches.

The ids are those of a ``tokenizers`` file of the kind "BPE with word ends" (a lower-casing
normalizer, a split into letter runs, single digits and runs of other marks). Nearly all the time of
such a tokenizer goes into the normalizer and the split, and natural text repeats its words, so plain
texts are split by Arrow and only words that were not met before are given to the tokenizer, many at
once. Texts with characters outside ``PLAIN`` go to the tokenizer whole. Both ways give the same ids.
"""

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The tokenizer's own split, without the letter runs, which are what is left between its matches.
SPLIT = r"('s|'t|'re|'ve|'m|'ll|'d|[^\s\pL\pN]+|\pN)"
# Not only these: control and format characters, exotic blanks, letters whose lower case depends on
# the library, combining marks, and the opening of a special token.
NOT_PLAIN = r"[^\t\n\f\r -~¡-įı-ſ‐-‧‰-⁞€]|<\|"
# Words kept with their ids per Python worker; words beyond it are encoded again in every batch.
KEPT_WORDS = 300_000
SLICE_BYTES = 1_000_000


def default_path() -> str:
    """The vocabulary file the queries use; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts. ``encode`` gives (offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # One copy of the vocabulary and merges serves both. What the file adds to them are special tokens,
        # whose opening sends a text the other way.
        self.words = Tokenizer(self.whole.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``texts``: strings; a null counts as empty."""
        counts, ids = self._slice(pc.fill_null(texts.cast(pa.large_string()), ""))
        return np.concatenate([[0], np.cumsum(counts)]), ids

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, NOT_PLAIN).to_numpy(zero_copy_only=False)
        strange = {
            int(i): np.array(e.ids, "<u4")
            for i, e in zip(
                np.flatnonzero(odd),
                self.whole.encode_batch_fast(
                    texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False
                ),
            )
        }
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
        split = pc.replace_substring_regex(pc.utf8_lower(plain), SPLIT, r" \1 ")
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(split))
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        bounds = bounds - bounds[0]
        words = coded.dictionary.to_pylist()
        held = self._ids_of(words)
        lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
        flat = np.frombuffer(b"".join(held), "<u4")
        starts = np.cumsum(lengths) - lengths
        each = lengths[which]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(starts[which] - (ends - each), each) + np.arange(total)]
        before = np.concatenate([[0], ends])
        counts = before[bounds[1:]] - before[bounds[:-1]]
        if not strange:
            return counts, ids
        at = np.concatenate([[0], np.cumsum(counts)])
        own = [strange.get(i, ids[at[i] : at[i + 1]]) for i in range(len(counts))]
        return np.array([len(x) for x in own], np.int64), np.concatenate(own)

    def _ids_of(self, words: list[str]) -> list[bytes]:
        known = self.known
        held = [known.get(word) if word else b"" for word in words]
        new = [i for i, ids in enumerate(held) if ids is None]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            text = " ".join([words[i] for i in part])
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                raise ValueError("the vocabulary does not mark the end of every word")
            data, start = ids.tobytes(), 0
            for i, stop in zip(part, (stops * 4).tolist()):
                held[i] = data[start:stop]
                start = stop
        for i in new[: max(0, KEPT_WORDS - len(known))]:
            known[words[i]] = held[i]
        return held


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def batches(path: str, source: Iterator[pa.RecordBatch], column: str):
    """For each Arrow batch, cut to about ``SLICE_BYTES`` of text: the rows, and the (offsets, ids) of
    their texts."""
    own = encoder(path)
    for batch in source:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES)) + 1
        bounds = [0, *cuts.tolist(), len(batch)]
        for first, last in zip(bounds, bounds[1:]):
            if last > first:
                part = batch.slice(first, last - first)
                yield part, own.encode(part.column(column))
