"""Small tables for the operators, and brute-force versions shared by several tests."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "n_words long, kept boolean, row string, key string, ids string, spans string, part long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def documents(spark, rows):
    """(doc_id, text[, lang]) rows as a documents table whose further columns clash with results."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None if r[1] is None else len(r[1]), 7, None, "r", None, "i", "s", 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def saved(spark, rows, folder, name="documents"):
    """Writes the rows as a table of a data directory and gives the directory."""
    documents(spark, rows).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


EDGE_TEXTS = [None, "", " \t\n ", "one", "a b c d", "x" * 5000, "nbsp here   wide", "é ß 日本 😀"]
