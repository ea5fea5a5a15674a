"""Brute-force versions that several test modules use."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from tokenizers import Tokenizer

from baobab.llm.queries import WORD_TOKENS


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, near):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_lines(texts):
    """texts: {key: text} in order of key; what is left of each."""
    seen, gone = {}, defaultdict(set)
    for key in sorted(texts):
        ls = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate(re.split("(?<=\n)", texts[key]))]
        ls = [x for x in ls if x[1]]
        for k in range(len(ls) - 2):
            window = tuple(x for _, x in ls[k : k + 3])
            if window in seen:
                gone[key] |= set(range(ls[k][0], ls[k + 2][0] + 1))
            seen.setdefault(window, key)
    return {k: "".join(x for i, x in enumerate(re.split("(?<=\n)", t)) if i not in gone[k]) for k, t in texts.items()}


def check_packing(out, texts):
    """texts: list of (id, text)."""
    coder = Tokenizer.from_file(WORD_TOKENS)
    coder.encode_special_tokens = True
    want = Counter()
    for i, t in texts:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[i, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    return bins
