"""Spellings of cues and lengths of user parts."""

import time

import pytest

from tablewright.llm import pii

ANCHORS = pii.automaton()


@pytest.mark.parametrize("text, clean", [
    ("Social Security Number: 123-45-6789.", "Social Security Number: <ACCOUNT>."),
    ("Tax ID: 12-3456789 and TAX id 12-3456789", "Tax ID: <ACCOUNT> and TAX id <ACCOUNT>"),
    ("İİ Social security no. 123-45-6789", "İİ Social security no. <ACCOUNT>"),
    ("IbAn: DE89370400440532013000", "IbAn: <ACCOUNT>"),
    (f"see https://{'t' * 5000}:x@host.org/a now", "see <URL> now"),
])
def test_redacted(text, clean):
    assert pii.redacted(text, pii.spans(text, ANCHORS)) == clean


def test_long_failed_stretches_stay_linear():
    start = time.perf_counter()
    assert pii.spans("https://" + "a" * 1_000_000 + " x://" * 100_000, ANCHORS) == []
    assert time.perf_counter() - start < 5
