"""Token counts of whole texts: batches of about equal bytes, long texts cut where a token ends for sure."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus.llm.batches import extended
from lexcorpus.llm.store import without

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BATCH_BYTES = 1 << 18
PIECE = 1 << 15  # characters from which on a text is cut

_SPACES = "".join(map(chr, (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2070), 0x3000, 0xFEFF)))
#: Characters that no Unicode version calls white space.
_SOLID = rf"[^\s{_SPACES}]"
#: Letters, and signs that are no letter, digit or space, in every Unicode version.
_LETTER = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xffА-яぁ-ゖァ-ヺ一-龥가-힣]"
_SIGN = r"[.,;:!?()\[\]、。，！？]"
#: A token of a byte-level vocabulary holds white space at its beginning at most, and never a letter
#: followed by a sign. What precedes a token does not change how it is found.
_BOUNDARY = re.compile(rf"(?<={_SOLID})(?=[ \t\r\n])|(?<={_LETTER})(?={_SIGN})")


def pieces(text: str, whole: tuple[str, ...] = (), size: int = PIECE) -> Iterator[str]:
    """``text`` cut at safe boundaries, each cut the first one at least ``size`` characters after the
    one before. No cut lies inside a string of ``whole`` (special tokens). A text without such
    boundaries stays in one piece."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while cut := _BOUNDARY.search(text, at):
            at = cut.start()
            if not any(text.find(w, max(start, at - len(w) + 1), at + len(w) - 1) >= 0 for w in whole):
                break
            at += 1
        if cut is None:
            break
        yield text[start:at]
        start = at
    yield text[start:]


Lengths = Callable[[list[str]], list[int]]


class Counter:
    """Lengths of the encodings of texts by one vocabulary file: ``tokenizers`` reads .json,
    ``sentencepiece`` .model. No begin, end or other special token is added, and nothing is cut off
    or padded. Texts are only cut for byte-level vocabularies whose boundaries are known."""

    def __init__(self, vocabulary: str):
        if vocabulary.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
            self.lengths: Lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.cut, self.whole = False, ()
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import json

        from tokenizers import Tokenizer

        model = Tokenizer.from_file(vocabulary)
        model.no_truncation()
        model.no_padding()
        self.lengths = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(vocabulary, encoding="utf-8") as file:
            said = json.load(file)
        split, added = said.get("pre_tokenizer") or {}, said.get("added_tokens") or []
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.cut = bool(byte_level and plain and not said.get("normalizer"))
        self.whole = tuple(t["content"] for t in added)

    def count(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text; null counts as empty. The pieces of all texts are encoded
        in batches that end as soon as they hold ``BATCH_BYTES``, so no batch is much larger than
        another, whatever the texts are like."""
        n_bytes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
        n_tokens = np.zeros(len(texts), np.int64)
        batch: list[str] = []
        owners: list[int] = []
        held = 0

        def flush() -> None:
            np.add.at(n_tokens, owners, self.lengths(batch))
            batch.clear()
            owners.clear()

        for i, raw in enumerate(texts):
            if not raw:
                continue
            text = raw.decode("utf-8", "replace")
            for piece in pieces(text, self.whole) if self.cut else (text,):
                batch.append(piece)
                owners.append(i)
                held += len(piece)
                if held >= BATCH_BYTES:
                    flush()
                    held = 0
        if batch:
            flush()
        return n_bytes, n_tokens


_counters: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    """The counter of this worker; it is read once."""
    if vocabulary not in _counters:
        _counters[vocabulary] = Counter(vocabulary)
    return _counters[vocabulary]


def counted(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, limit: int = 512) -> DataFrame:
    """``docs`` without its texts, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens).

    Rows stay where they are: nothing is shuffled or collected, and only lengths leave Python. Null
    and empty texts have no bytes and no tokens; nulls in other columns and repeated rows are kept;
    very long texts are cut at safe boundaries and their pieces counted in turn, one text without a
    boundary at once; bytes that are no UTF-8 are read as replacement characters; an empty table
    stays empty. Columns called n_bytes, n_tokens or over_limit are replaced.
    """
    rows = without(docs, ("n_bytes", "n_tokens", "over_limit"))
    rows = rows.withColumn(text, F.col(f"`{text}`").cast("binary"))
    made = extended(rows, text, "n_bytes long, n_tokens long", lambda texts: counter(vocabulary).count(texts))
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
