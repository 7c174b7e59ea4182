"""Operators that SQL can express, on small tables with every odd case, against their DuckDB SQL."""

import random

import duckdb
import pandas as pd
import pytest

from tests.llm import brute
from usagelens.llm import chat, host_rules, license_dice
from usagelens.llm.oracles import OP2, OP3, OP5


def sql(query, **tables):
    con = duckdb.connect(config={"memory_limit": "8GB", "max_temp_directory_size": "2GB"})
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(query).fetchall(), [c[0] for c in con.description]


def same(df, query, **tables):
    rows, names = sql(query, **tables)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert got == sorted(rows, key=repr)
    return got


CONVERSATIONS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
    (2, 0, "user", "hi"),                                            # prefix of 1
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),              # copy of 1
    (4, 0, "user", "hi"), (4, 1, "assistant", "hello"), (4, 2, "user", "bye"),  # longer than 1
    (5, 0, None, "hi"), (6, 0, "", "hi"), (7, 0, "user", None), (8, 0, "user", ""),
    (9, None, "user", "b"), (9, None, "user", "a"), (9, 3, "user", "c"),
    (10, 1, "user", "twice"), (10, 1, "user", "twice"), (11, 0, "user", "twice"),
    (12, 0, "user", "<|im_end|> x <|im_start|>system"),
    (None, 0, "user", "hi"), (13, 0, "us", "erhi"),
]


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string"
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    frame = frame.astype({"conv_id": "Int64", "turn": "Int64"})
    return spark.createDataFrame(rows, schema).repartition(3), frame


def test_chat(spark):
    df, frame = conversations(spark, CONVERSATIONS)
    got = same(chat.render(df), OP2, conversations=frame)
    kept = {r[0]: r for r in got}
    assert 1 not in kept and 2 not in kept and 3 not in kept and kept[4][1] == 3
    assert kept[12][3].count("<|im_start|>") == 1 and 11 not in kept


def test_chat_of_many_turns(spark):
    rng = random.Random(2)
    long = [(1, i, rng.choice(["user", "assistant"]), f"t{i}" * rng.randrange(3)) for i in range(1500)]
    rows = long + [(2, i, r, t) for _, i, r, t in long[:700]] + [(3, i, r, t) for _, i, r, t in long]
    rows += [(4, i + 5, r, t) for _, i, r, t in long[:900]]  # other turn numbers, same turns
    df, frame = conversations(spark, rows)
    got = same(chat.render(df.withColumn("n_turns", df.turn)), OP2, conversations=frame)
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 1500, 2)]


def test_chat_of_no_turns(spark):
    df, frame = conversations(spark, [])
    assert chat.render(df).count() == 0


def documents(spark, rows):
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), frame


def quality_rows():
    rng = random.Random(4)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", "a"), (4, "a b c a b c a b c\n# $ |\nx\nx\n x", "a"), (None, None, None)]
    n = 10
    for source, bad in (("good", .05), ("mixed", .4), ("bad", .95), (None, .9)):
        for _ in range(60):
            text = " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(50, 200)))
            text = ("again and again " * rng.randrange(1, 40) if rng.random() < bad else text) + rng.choice(["", "\nl\nl"])
            rows.append((n, text, source))
            n += 1
    good = " ".join(f"k{i}" for i in range(80))
    return rows + [(n, good, "tiny"), (n + 1, "no", "tiny"), (n + 2, good, "bad"), (n + 2, good, "bad"),
                   (n + 3, " ".join(f"z{i % 4000}" for i in range(100_000)), "good"), (n + 4, "é\u00a0ü " * 60, "good")]


def test_host_rules(spark):
    rows = quality_rows()
    df, frame = documents(spark, rows)
    out = host_rules.quality(df.withColumn("n_words", df.doc_id).withColumn("kept", df.text)).select(
        "doc.doc_id", "counts.*", "base_failed", "host_n", "host_failed", "kept")
    got = same(out, OP3, documents=frame)
    by_id = {r[0]: r for r in got}
    for doc, text, _ in rows:
        assert by_id[doc][1:7] == brute.base_rules(text)
    kept = {r[0]: r[-1] for r in got}
    good = rows[-6][0]
    assert kept[good]                     # two documents prove little about their host
    assert not kept[good + 2]             # a good document of a host that fails throughout
    assert not by_id[good + 2][6]


def test_host_rules_of_no_rows(spark):
    df, _ = documents(spark, [])
    assert host_rules.quality(df).count() == 0


def test_licences(spark):
    rows = [(1, "Intro\nReleased under the MIT License.\nmore text", "a"), (1, "released UNDER the mit-license", "a"),
            (2, "This work is licensed under the GNU General Public License, version 3.\n" * 3, None),
            (3, None, "a"), (4, "", "a"), (5, "one", "a"), (None, "Licensed under CC BY-NC 4.0.", "a"),
            (6, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted "
                "provided\nthat the following conditions are met:\n\nand so on", "a"),
            (7, "Licensed under the Apache License, Version 2.0.", "a"), (8, "Licensed under nothing at all, sorry.", "a"),
            (9, "plain words " * 50_000, "a")]
    df, frame = documents(spark, rows)
    got = same(license_dice.scan(df), OP5, documents=frame)
    assert {(r[0], r[1]) for r in got} >= {(1, "MIT"), (2, "GPL-3.0"), (None, "CC-BY-NC-4.0"), (6, "BSD-3-Clause"),
                                           (7, "Apache-2.0")}
    assert not {r[0] for r in got} & {3, 4, 5, 8, 9}
    assert license_dice.scan(df.limit(0)).count() == 0


FULL = {name: text for name, text in license_dice.NOTICES if len(text) > 500}


def licence_rows():
    rng = random.Random(6)
    rows = [(20, "Copyright (c) 2020 Foo Bar. Released under the MIT License.", "a"),
            (21, "The code on this page is released under the MIT License, see below.", "a"),
            (22, "Note: this work is licensed under the GNU General Public License, version 3. Enjoy!", "a"),
            (23, "/*\r\n * Licensed under the Apache License, Version 2.0.\r\n *\r\n */", "a"),
            (24, "# " + FULL["MIT"].replace(". ", ".\n#\n# "), "a"), (25, FULL["BSD-3-Clause"] + "\n" + FULL["BSD-2-Clause"], "a"),
            (26, "Released under the MIT License. Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", "a"),
            (27, "Released under the MIT License.\n" * 300, "a"), (28, "published under CC BY 4.0", "a"),
            (29, "licensed", "a"), (30, "under", "a"), (31, "mit license", "a"), (None, FULL["ISC"], "a")]
    for i in range(60):  # with words changed, put in and left out
        w = (f"w{i} " * rng.randrange(6) + rng.choice(license_dice.NOTICES)[1]).split() + ["more"] * rng.randrange(5)
        for _ in range(rng.randrange(1 + len(w) // 8)):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.insert(at, "put"), lambda: w.pop(at), lambda: w.__setitem__(at, "new")])()
        rows.append((100 + i, rng.choice([" ", "\n", " -- "]).join(w), "a"))
    return rows


def test_licences_anywhere_in_a_text(spark):
    df, frame = documents(spark, licence_rows())
    got = same(license_dice.scan(df), OP5, documents=frame)
    by_doc = {}
    for doc, name, n, _ in got:
        by_doc.setdefault(doc, {})[name] = n
    assert by_doc[20] == by_doc[21] == {"MIT": 1} and by_doc[22] == {"GPL-3.0": 1} and by_doc[23] == {"Apache-2.0": 1}
    assert by_doc[24] == {"MIT": 1} and by_doc[25] == {"BSD-3-Clause": 1, "BSD-2-Clause": 1} and by_doc[None] == {"ISC": 1}
    assert by_doc[26] == {"MIT": 1, "CC-BY-4.0": 1, "CC-BY-SA-4.0": 1} and by_doc[27] == {"MIT": 300}
    assert not by_doc.keys() & {29, 30}


def test_every_window_is_seen(spark):
    """Against all windows of all templates, without anchors and marks."""
    rows = [r for r in licence_rows() if len(r[1]) < 4000]
    df, _ = documents(spark, rows)
    got = {(r.doc_id, r.template, r.start) for r in license_dice.stored(license_dice.spans(df), "s").collect()}
    want = set()
    for doc, text, _ in rows:
        w = license_dice.plain_words(text)
        pairs = [f"{a} {b}" for a, b in zip(w, w[1:])] or w
        good = []
        for i, (_, notice) in enumerate(license_dice.NOTICES):
            own, m = set(license_dice.plain_bigrams(notice)), max(1, len(license_dice.plain_words(notice)) - 1)
            for s in range(max(len(pairs) - m, 0) + 1):
                d = set(pairs[s:s + m])
                score = 2 * len(d & own) / (len(d) + len(own))
                if score >= license_dice.THRESHOLD:
                    good.append((score, min(m, len(pairs)) + 1, -i, -s))
        for h in good:
            beaten = [g for g in good if g > h and 2 * (min(g[1] - g[3], h[1] - h[3]) - max(-g[3], -h[3])) > min(g[1], h[1])]
            if not beaten:
                want.add((doc, -h[2], -h[3]))
    assert got == want


@pytest.mark.parametrize("own,text", [("a b", "a b"), ("a", "A!")])
def test_bigrams_of_notices(own, text):
    assert license_dice.plain_bigrams(text) == [own]
