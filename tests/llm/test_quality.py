from collections import Counter

import pytest

from braidwork.llm.quality import RULES, Rule, apply_rules, keep_good, quality_metrics, quality_rules


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    words = split(text)
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(grams)
    inside = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


TEXTS = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "x x x x", "x x x", "é# ß|<> ñ\n\né# ß|<> ñ\n", "a b c d a b c d e a b", "w " * 20_000,
    "line\nline\nline \n", "the and of to " * 30, "q" * 100_000, "a b c d",
]


def test_counts(make_docs):
    rows = quality_metrics(make_docs(list(enumerate(TEXTS)))).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_decisions_and_columns(make_docs):
    good = " ".join(f"the word{k} of item{k}" for k in range(30))
    rows = [(1, good), (2, "too short"), (3, "spam ham eggs " * 40), (None, good), (1, good), (4, None)]
    docs = make_docs(rows)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 1, None])
    by = {r.doc_id: r for r in quality_rules(docs).filter("not kept").collect()}
    assert by[2].base_failed and by[3].base_failed and by[4].base_failed and "n_words" in by[2].failed_rules
    assert quality_rules(make_docs([])).count() == 0


@pytest.mark.parametrize(("rule", "kept"), [(Rule("n_words", 2, None), 1), (Rule("n_words", None, 1), 0), (Rule("mean_word_chars", 3, 3), 1)])
def test_thresholds(make_docs, rule, kept):
    out = apply_rules(quality_metrics(make_docs([(1, "abc def")])), (rule,)).first()
    assert out.failed_rules == ("" if kept else rule.metric)
    assert len(RULES) == 7
