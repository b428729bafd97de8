import re
from collections import Counter

from braidwork.llm.licenses import PHRASES, TEMPLATES, license_scan, need, template_table


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(text):
    ws = words(text)
    places, base = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        hits = [k for k in range(len(ws)) if ws[k : k + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    labels, best = set(base), 0.0
    for line in (text or "").split("\n"):
        ws = words(line)
        for k, label, ts in template_table(TEMPLATES):
            n = len(TEMPLATES[k][1].split())
            shared = max((len(set(ws[i : i + n + max(1, n // 4)]) & set(ts)) for i in range(len(ws))), default=0)
            if shared >= need(len(ts), 0.8):
                labels.add(label)
                best = max(best, shared / len(ts))
    ws = words(text)
    return (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best)


def test_against_brute_force(spark, make_docs):
    gpl = next(t for label, t in TEMPLATES if label == "gpl")
    texts = [
        None, "", " ...", "Released under the MIT License.", "under the mit\nlicense, under THE mit LICENSE", "x apache license version 2 y apache license version 2.0",
        "CC BY-NC 4.0", gpl.upper(), " ".join(gpl.split()[3:]), " ".join(gpl.split()[: len(gpl.split()) // 2]), "é under the mit licenseé",
        "mit " * 5000, "Licensed under cc by nc\nthis work is licensed under the creative commons attribution 4 0 international license",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[6]), (7, "plain")]
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in license_scan(make_docs(rows)).collect())
    assert got == Counter((i, *brute(t)[:-1], round(brute(t)[-1], 9)) for i, t in rows)
    assert license_scan(make_docs([])).count() == 0


def test_short_notices(spark, make_docs):
    texts = {0: "This work is licensed under the GNU General Public License, version 3.", 1: "prose\nAll rights reserved.\nprose", 2: "all the rights of man"}
    got = {r.doc_id: (r.base_labels, r.labels, r.score, r.n_blocks) for r in license_scan(make_docs(list(texts.items()))).collect()}
    assert got == {0: ("", "gpl", 1.0, 1), 1: ("", "proprietary", 1.0, 1), 2: ("", "", 0.0, 0)}


def test_words_of_a_notice_strewn_over_a_line_are_none(spark, make_docs):
    bsd = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met".split()
    texts = [
        "The film was released under a new title while the driver kept a license in the car", "Rights to all of the land were reserved for the crown",
        "the general store sold public goods under the table with a new version of gnu milk license", " ".join(w + " so it went" for w in bsd),
        "Well: all rights are reserved here", "x " * 40 + "released under the old mit license" + " y" * 40,
    ]
    got = {r.doc_id: r.labels for r in license_scan(make_docs(list(enumerate(texts)))).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "", 4: "proprietary", 5: "mit"}


def test_wrapped_notices(spark, make_docs):
    gpl = next(t for label, t in TEMPLATES if label == "gpl").split()
    texts = [
        "# All rights\n# reserved.",
        "a\n" + " * ".join(w + ("\n" if k % 4 == 3 else " ") for k, w in enumerate(gpl)) + "\nb",
        "\n".join(gpl),
        "All\nof us have\nrights, and a table is\nreserved.",
        "All rights reserved.\nAll rights\nreserved.",
        "released under the mit license\nunder a tree",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0])] * 2
    got = [(r.doc_id, r.labels, r.score) for r in license_scan(make_docs(rows)).collect()]
    want = ["proprietary", "gpl,lgpl", "gpl,lgpl", "", "proprietary", "mit"]  # at 80 %, as on one line
    assert Counter(got) == Counter([(k, w, 1.0 if w else 0.0) for k, w in enumerate(want)] + [(None, "proprietary", 1.0)] * 2)
    n = {r.doc_id: r.n_blocks for r in license_scan(make_docs(rows)).collect()}
    assert (n[0], n[3], n[4], n[5]) == (1, 0, 2, 1) and n[1] > 0
