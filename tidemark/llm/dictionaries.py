"""Zstandard dictionaries from whatever there is to learn from."""

from __future__ import annotations

SIZE = 64 << 10
#: A sample is cut into pieces of at most so many bytes, so that a few long ones are enough to train on.
PIECE = 8 << 10
MAGIC = (0xEC30A437).to_bytes(4, "little")


def train(samples: list[bytes], size: int = SIZE) -> bytes:
    """A dictionary of at most `size` bytes; empty only if no sample has a byte.

    Where the samples are too few or too much alike to train on, their own last
    bytes are the dictionary: any content serves as one.
    """
    import zstandard

    total = sum(map(len, samples))
    piece = max(64, min(PIECE, total // 256))
    parts = [s[a : a + piece] for s in samples for a in range(0, len(s), piece)]
    if len(parts) >= 16:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 4)), parts).as_bytes()
        except zstandard.ZstdError:  # too little in them
            pass
    raw, held = [], 0
    for s in reversed(samples):
        raw.append(s[-size:])
        held += len(raw[-1])
        if held >= size:
            break
    content = b"".join(reversed(raw))[-size:]
    return b"\0" + content[1:] if content.startswith(MAGIC) else content
