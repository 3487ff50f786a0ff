"""Token ids of whole texts with a public byte-level BPE vocabulary, and their counts."""
from __future__ import annotations

import base64
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import tiktoken

#: Where the files of the public tokenizers lie; on every machine, or only on the driver, which sends the ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How this vocabulary's texts are cut before merging (fixed value of the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of the pattern in runs that its regular expression can't take in one piece.
_LONG_GAP = re.compile(r"[ \t\n\v\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")



def ranks_of(path: str = VOCABULARY) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


def encoder(ranks: dict[bytes, int]) -> Callable[[str], bytes]:
    """text -> little-endian token ids (2 bytes each, or 4 if the vocabulary needs them).

    The pattern makes one piece of a run of white space, but for its last character if a word follows, so very long runs are
    merged as that piece, and the texts between them are encoded alone.
    """
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    kind = id_type(ranks)

    def encode(text: str) -> bytes:
        ids, start = [], 0
        for gap in _LONG_GAP.finditer(text) if len(text) >= 4096 else ():
            end = gap.end() - (gap.end() < len(text))
            ids += encoding.encode_ordinary(text[start : gap.start()]) + encoding._encode_single_piece(text[gap.start() : end])
            start = end
        return np.array(ids + encoding.encode_ordinary(text[start:]), kind).tobytes()

    return encode


def id_type(ranks: dict[bytes, int]) -> str:
    return "<u2" if max(ranks.values()) < 65535 else "<u4"
