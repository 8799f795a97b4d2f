"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib


def cut_repeats(docs, span=50):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256 of what stays)} from (doc_id, text) pairs."""
    least: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in docs]
    for i, text in texts:
        for k in range(len(text) - span + 1):
            s = text[k : k + span]
            if i < least.get(s, i + 1):
                least[s] = i
    out = {}
    for i, text in texts:
        gone = bytearray(len(text))
        for k in range(len(text) - span + 1):
            if least[text[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out[i] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
