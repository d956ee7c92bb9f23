"""Plain Python versions of the operators' results, and frames of documents to try them on."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source) as a documents table."""
    return spark.createDataFrame(
        [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], SCHEMA)


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near_components(rows):
    """doc_id: (n_shingles, component_id) by comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= .75 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


def without_repeats(rows, width):
    """(doc_id, n_words, n_removed, sha256 of the kept words) of every row."""
    texts = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def token_pieces(rows, most, encode):
    out = Counter()
    for d, t in rows:
        ids = encode(t or "") + [1]
        for p, s in enumerate(range(0, len(ids), most)):
            cut = ids[s:s + most]
            data = b"".join(i.to_bytes(4, "little") for i in cut)
            out[(d, p, s, len(cut), zlib.crc32(data))] += 1
    return out
