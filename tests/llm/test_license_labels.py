"""Every license line and text gets the label it names, and no other."""

import random

import pytest

from martloom.llm.licenses import LICENSES, Licenses, licensed, words_of

FILLER = "lorem ipsum dolor the of a and to is in software work".split()


def labels_of(text, found=Licenses(LICENSES, 0.85, {})):
    return {found.labels[t] for t, _, _ in found.matches(words_of(text.encode()))}


@pytest.mark.parametrize("label, template", LICENSES)
def test_a_planted_line_has_one_label(label, template):
    rng = random.Random(len(template))
    for n in (0, 7, 300):
        assert labels_of(" ".join(rng.choices(FILLER, k=n) + [template] + rng.choices(FILLER, k=n))) == {label}


def test_words_in_any_order_are_no_notice():
    assert labels_of("by 4 cc lorem under 0 licensed nc sa nd") == set()
    assert labels_of("licensed lorem ipsum under dolor lorem cc ipsum dolor by lorem ipsum 4 0") == set()


def test_lines_next_to_each_other_all_count():
    assert labels_of("Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.") == {"cc-by", "cc-by-nc"}


def test_labels_of_a_table(spark):
    docs = spark.createDataFrame([(1, "x Licensed under CC BY-NC 4.0. y"), (2, "plain"), (3, None)], "doc_id LONG, text STRING")
    assert [(r.doc_id, r.labels, r.score) for r in licensed(docs).collect()] == [(1, "cc-by-nc", 1.0), (2, "", 0.0), (3, "", 0.0)]


@pytest.mark.parametrize("start, label", [
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY", "mit"), ("Neither the name", "bsd"), ("Grant of Patent", "apache"),
    ("You may convey verbatim", "gpl"), ("You may convey a Combined", "lgpl"), ("Notwithstanding", "agpl"),
    ("Permission to use, copy", "isc"), ("Anyone is free to copy", "unlicense"),
])
def test_a_changed_body_without_a_notice(label, start):
    (text,) = [t for _, t in LICENSES if t.startswith(start)]
    words = text.split()
    del words[len(words) // 2]
    assert labels_of("x " * 90 + " ".join(words) + " y" * 90) == {label}
