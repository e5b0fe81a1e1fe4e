"""Copies of a notice that stand close together, among words of the template."""

import random

import pytest

from pricetrail.llm.license_scan import FOLD, TEMPLATES, WORD, Template


def spans(template, text):
    return [(a, b) for a, b, _ in template.find(WORD.findall(text.translate(FOLD)))]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
@pytest.mark.parametrize("copies", [1, 2, 3, 7])
def test_copies_with_common_words_around(name, copies):
    template, n = Template(name, TEMPLATES[name]), len(WORD.findall(TEMPLATES[name]))
    text = "the " + " ".join([TEMPLATES[name]] * copies) + " Other words follow here at once"
    assert spans(template, text) == [(1 + k * n, (k + 1) * n) for k in range(copies)]


def test_edited_copies_stay_apart():
    template = Template("MIT-header", TEMPLATES["MIT-header"])
    words = template.words
    edited = [words[:9] + ["other"] + words[10:], words[:3] + words[4:], words[:20] + ["more", "words"] + words[20:]]
    text = ["to", "the"] + sum(edited, []) + ["of", "the", "end"]
    ends = [2, 2 + len(edited[0]), 2 + len(edited[0] + edited[1]), 2 + len(sum(edited, []))]
    assert [(a, b) for a, b, _ in template.find(text)] == [(a, b - 1) for a, b in zip(ends, ends[1:])]


def test_long_templates_in_copies():
    r = random.Random(5)
    body = [r.choice(["the", "of", "to", "and"]) if r.random() < 0.5 else f"w{r.randrange(300)}" for _ in range(900)]
    template = Template("whole", " ".join(body))
    text = ["of", "the"] + body + body + ["to", "end"]
    assert [(a, b) for a, b, _ in template.find(text)] == [(2, 901), (902, 1801)]
    assert template.find([r.choice(["the", "of", "to", "and"]) for _ in range(5000)]) == []
