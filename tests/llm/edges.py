"""Tables with the rows that operators must bear: NULLs, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "score double, node string, id bigint, spans string, key_id bigint, body string, place int, label string"
)
LONG = " ".join(f"word{i % 977} of{i % 13} tale{i}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    (0, "Plain words stand here, and some more of them follow after that.\nA second line.\nMail a.b@example.com now."),
    (1, None),
    (2, ""),
    (3, LONG),
    (4, PASSAGE + " one ending"),
    (5, PASSAGE + " other ending"),
    (6, PASSAGE + " one ending"),
    (6, PASSAGE + " one ending"),
    (7, "same id, first text " + PASSAGE),
    (7, "same id, second text"),
    (None, "row without id " + PASSAGE),
    (None, None),
    (8, "ab " * 300),
    (9, "One"),
    (10, "Été  <|endoftext|> naïve  　 日本語 \x1c tabs\t\tand\r\nlines  "),
    (11, "+1 (555) 010-9999 and 10.0.0.255 and 4111 1111 1111 1111, token = \"9f8e7d6c5b4a39281706\""),
    (12, "Released under the MIT License. Also CC BY-NC 4.0."),
    (-5, "negative id " + PASSAGE[:250]),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, None, None, None if t is None else len(t), 0.5, "n", 1, "s", 2, "b", 3, "l") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def word_list(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
