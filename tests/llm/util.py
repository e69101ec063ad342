"""Small fixtures and brute-force helpers for the training-data operators."""

import re

import pandas as pd

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE_TEXTS = [
    None, "", "   \n\t ", "one", "one two three", "Same text here, same text here.", "Same text here, same text here.",
    "ÉCOLE İstanbul ẞ ǅ H̱ ẖ a b 　 日本語 テスト 😀", "a\x0bb\x0cc\rd", "###$$$ %%% &&& |<>|",
    "line\nline\n\nline\nother", LONG, LONG + " tail", "<|endoftext|> it's <|ENDOFTEXT|> we'll x<|startoftext|>y \x00 z",
]


def docs_frame(spark, texts=EDGE_TEXTS, ids=None):
    """Documents with null ids, a repeated row and extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None if k % 3 == 0 else f"s{k % 2}", 7, "x", 1.5, True, 3)
            for k, (i, t) in enumerate(zip(ids, texts))]
    rows.append(rows[4])
    rows.append((None, "null id text one two three four", None, None, None, None, None, None, None))
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id string, score double, "
              "kept boolean, size long")


def empty(spark):
    return docs_frame(spark).limit(0)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def read(sf, name):
    return pd.read_parquet(f"/root/testdata/{sf}/{name}.parquet")


def auc(score, label):
    rank = pd.Series(score).rank()
    pos = sum(label)
    return (sum(r for r, y in zip(rank, label) if y) - pos * (pos + 1) / 2) / (pos * (len(label) - pos))
