"""Small tables with the awkward rows every operator has to take."""

import random
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside, as further columns of the input.
CLASHING = ["id", "x", "label", "term", "window", "shard", "component", "rep", "language", "confidence", "accepted",
            "kept", "weight", "probability", "size", "d", "sig", "part", "key", "lane", "place", "words", "n", "held_out"]


def words(text):
    return SPACED.findall((text or "").translate(LOWER))


def fold(key, folds):
    return zlib.crc32(str(key).encode()) % folds


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_documents():
    """(doc_id, text, lang, source): near and exact copies, ties, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 4, 12, 40, 90, 200)]
    rows = [(i, t, "en", "src0") for i, t in enumerate(base)]
    for k, t in enumerate(base[2:]):
        w = t.split()
        rows.append((20 + k, t, "de", "src1"))                            # exact copy
        rows.append((30 + k, " ".join(w[:-1] + ["changed"]), "en", None))   # near copy at the end
        rows.append((40 + k, " ".join(["new"] + w[:-2] + ["more", "words"]), None, "src0"))
    chain = base[4].split()
    for k in range(6):                                                    # each like the one before
        chain = chain[1:] + [f"c{k}"]
        rows.append((50 + k, " ".join(chain), "fr", "src2"))
    rows += [(60, None, "en", "src0"), (61, "", "en", "src0"), (62, " \t\n ", None, None), (63, "Ärger ÄRGER one", "de", "src1"),
             (64, prose(rng, 30000, 3000), "en", "src0"), (65, "one two", "en", "src0"), (66, "ONE two", "en", "src0"),
             (65, "one two", "en", "src0"), (None, base[5], "en", "src0"), (None, None, None, None)]
    return rows


def with_clashing(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING if c not in df.columns])
