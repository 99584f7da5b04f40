import re

from lanwatch.llm import licenses
from tests.llm.util import docs_frame


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    out = []
    for d, t in rows:
        t = lowered(t)
        split = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s)
        w, at, base, labels, score = split(t), [], set(), set(), 0.0
        for p, label in licenses.PHRASES.items():
            p = p.split()
            hits = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            at += hits
            base |= {label} if hits else set()
        for label, text in licenses.TEMPLATES:
            s = set(text.split())
            for i in range(len(w)):
                n = len(s & set(w[i:i + licenses.span(text)])) if w[i] in s else 0
                if n >= licenses.THRESHOLD * len(s) - 1e-9:
                    labels.add(label)
                    score = max(score, n / len(s))
        out.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else score))
    return sorted(out, key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in licenses.license_scan(docs_frame(spark, rows)).collect()), key=str)


def test_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (902, "MIT\nLicense mit-license MIT  LICENSES"), (903, "ALL rights\nreserved"), (904, "x All  Rights, Reserved! y " * 50),
             (905, "gnu general gnu general public license GNU GENERAL PUBLIC LICENSE"), (None, "CC BY 4.0, cc-by, ccby"), (906, "é apache LICENSEé apache_license"),
             (907, licenses.TEMPLATES[3][1].replace("hereby", "now")), (908, licenses.TEMPLATES[3][1][:60]), (909, "KK license İ word"),
             (910, licenses.TEMPLATES[1][1].upper() + " and more"), (911, licenses.TEMPLATES[5][1].replace(" ", "\n"))]
    rows += rows[-3:]
    got = run(spark, rows)
    assert got == brute(rows) and any(g[6] == "all-rights-reserved" and g[7] == 1.0 for g in got)


def test_similar_blocks_against_all_windows(spark):
    import random
    r = random.Random(3)
    templates = [(f"t{k}", " ".join(r.choices("abcdefghijklmnop", k=r.randrange(2, 9)))) for k in range(12)]
    rows = [(i, " ".join(r.choices("abcdefghijklmnopqrst", k=r.randrange(40)))) for i in range(150)]
    df = docs_frame(spark, rows).selectExpr("doc_id AS _id", "text")
    got = [(x._id, x.start, x.template, x.label, x.shared, x.m) for x in licenses.scan(df, templates).collect()]
    want = set()
    for i, t in rows:
        w = t.split()
        for j, (label, text) in enumerate(templates):
            s = set(text.split())
            for a in range(len(w)):
                n = len(s & set(w[a:a + licenses.span(text)]))
                if w[a] in s and n >= 0.8 * len(s) - 1e-9:
                    want.add((i, a, j, label, n, len(s)))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


MIT = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software")"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:"""
GPL = """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3"""
EDITED = """Permission is granted hereby, free of any charge, to each person
who obtains a copy of this software and the associated documentation files"""


def test_wrapped_notices_found_and_scattered_words_not(spark):
    seats = "all the reserved seats and rights of way " + "word " * 200
    apart = " ".join(f"{w} and then some other things" for w in "permission is hereby granted free of charge to any person obtaining a copy".split())
    rows = [(1, MIT), (2, BSD), (3, GPL), (4, EDITED), (5, "long " * 30000 + MIT.replace(" ", "\n") + " text" * 30000),
            (6, seats), (7, apart), (8, "All\nrights\nreserved."), (9, "rights all " * 50 + "reserved")]
    got = {r[0]: r[6] for r in run(spark, rows)}
    assert got == {1: "mit", 2: "bsd", 3: "gpl", 4: "mit", 5: "mit", 6: "", 7: "", 8: "all-rights-reserved", 9: "all-rights-reserved"}


def test_names_that_clash(spark):
    from pyspark.sql import functions as F
    df = docs_frame(spark, [(1, MIT), (2, None)])
    for c in ("_id", "_t", "_w", "token", "template", "label", "score", "found", "start", "_all"):
        df = df.withColumn(c, F.lit("x"))
    got = {r[0]: r[6] for r in licenses.license_scan(df).collect()}
    assert got == {1: "mit", 2: ""}


def test_empty(spark):
    assert run(spark, []) == []
