from __future__ import annotations

import random

from tests.llm.edges import TEXTS, documents, no_documents, word_list
from touchline.llm import licenses

EXTRA = [
    (20, "under the MIT License under the mit license"),
    (21, "UNDER THE\nMIT--LICENSE, Apache License, version 2; cc-by-nc"),
    (22, "under the mit  licenses and apache license version 20"),
    (23, "This work is licensed under the GNU General Public License, version 3."),
    (24, "permission is hereby granted, free of charge, to any person obtaining a copy of the said software and documentation"),
    (25, "the license of the work is free to use and to copy"),
]


def brute_base(text):
    w = word_list(text)
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def test_base_places_and_labels(spark):
    texts = TEXTS + EXTRA
    got = licenses.scan(documents(spark, texts), ["doc_id", "text", "label"]).collect()
    assert len(got) == len(texts)
    for r in got:
        mine = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert mine == brute_base(r["text"]), r["doc_id"]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (not r["base_labels"] or r["score"] == 1)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[23] == "gpl-3" and labels[24] == "mit" and labels[25] == "" and labels[0] == ""


def test_matching_statistics_equal_a_plain_search():
    use = licenses.automaton(licenses.TEMPLATES)
    templates = [word_list(t) for _, t in licenses.TEMPLATES]
    vocabulary = sorted({w for t in templates for w in t})
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    random.seed(3)
    for _ in range(60):
        text = []
        while len(text) < 40:
            t = random.choice(templates)
            at = random.randrange(len(t))
            text += t[at : at + random.randint(1, 9)] + random.choices(vocabulary + ["zzz"], k=random.randint(0, 2))
        got = use.statistics(licenses.word_ids(" ".join(text)))
        for i, (size, state) in enumerate(got):
            longest = max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in runs), default=0)
            assert size == longest
            if size:
                run = text[i + 1 - size : i + 1]
                places = {(t, e) for t, w in enumerate(templates) for e in range(size - 1, len(w)) if w[e + 1 - size : e + 1] == run}
                assert use.ends[state] == places


def test_chains_bridge_small_gaps_only():
    use = licenses.automaton(licenses.TEMPLATES)
    words = "this work is licensed under a creative commons attribution noncommercial 4 0 international license".split()
    spans = lambda text: [s for s in use.spans(licenses.np.array(licenses.word_ids(text), "uint64")) if licenses.accepted(s)]
    near = spans(" ".join(words[:6] + ["x", "y"] + words[6:]))
    assert any(s.label == "cc-by-nc" and s.covered == len(words) for s in near)
    far = spans(" ".join(words[:7] + ["x"] * 40 + words[7:]))
    assert not any(s.covered == len(words) for s in far)


NOTICES = [
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc-by-nd", "Photos by Ann, licensed under CC BY-ND 4.0, text by Bo."),
    ("lgpl-3", licenses.gnu_notice("library", "Lesser General Public License", "3")),
    ("agpl-3", licenses.gnu_notice("program", "Affero General Public License", "3")),
    ("gpl-2", licenses.gnu_notice("program", "General Public License", "2")),
    ("gpl-3", "It is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
     "by the Free Software Foundation, either version 3 of the License"),
    ("mpl-2", "Mozilla Public License Version 2.0"),
    ("mpl-2", licenses.MPL_NOTICE),
    ("epl-2", licenses.EPL_NOTICE),
    ("isc", licenses.ISC_GRANT + " " + licenses.AS_IS[:60]),
    ("bsd-3", licenses.BSD_CONDITIONS + " " + licenses.BSD_NAMES),
    ("bsd-2", licenses.BSD_CONDITIONS + " " + licenses.BSD_AS_IS),
    ("mit", licenses.MIT_GRANT.replace("Software", "Work") + licenses.AS_IS),
    ("apache-2", licenses.APACHE_NOTICE),
    ("unlicense", licenses.UNLICENSE[:150]),
    ("agpl-3,mit", "The server is released under the GNU Affero General Public License, version 3; " + "it has many parts and users " * 3 +
     "and the client is released under the MIT License."),
    ("", "The library is free for all who read; a license to publish is granted by the ministry under the terms of the law."),
    ("", "We redistribute bread in source villages and the General Assembly of the public met."),
]


def test_standard_notices_get_the_label_of_their_own_license(spark):
    texts = [(i, f"Some words before it.\n{text}\nAnd words after it.") for i, (_, text) in enumerate(NOTICES)]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, texts), ["doc_id"]).collect()}
    for i, (labels, text) in enumerate(NOTICES):
        assert got[i]["labels"] == labels, (text, got[i]["spans"])


def test_empty_table(spark):
    assert licenses.scan(no_documents(spark), ["doc_id"]).collect() == []
