"""Secrets are scored by their whole value, however long."""

from __future__ import annotations

from ballast.llm import secret_scan


def test_a_long_value_is_scored_to_its_end():
    real = "Zq9X7vB2nM4kL8pR"
    for text, start in ((f'token = "{"x" * 600}{real}"', 9), (f'a = "{"x" * 600}"\ntoken = a + "{real}"', 5)):
        spans = [s for s in secret_scan.secret_spans(text) if s[2] == "literal"]
        assert spans[0][0] == start and text[spans[-1][0] : spans[-1][1]].endswith(real)
    spaced = f'token = "{real * 40} {real}"'
    assert not [s for s in secret_scan.secret_spans(spaced) if s[2] == "literal"]  # the space comes after 640 characters


def test_long_placeholders_stay_placeholders():
    for value in ("x" * 700, "xX" * 400, "*" * 700, f"<{'q9' * 400}>", f"${{{'q9' * 400}}}"):
        assert secret_scan.score("token", value) == 0.0
    assert secret_scan.score("token", "x" * 300 + "q9Z" + "x" * 300) > 0.0


def test_constants_doubled_many_times_stay_cheap():
    text = "a0 = 'q9X7vB2n'\n" + "".join(f"a{i} = a{i - 1} + a{i - 1}\n" for i in range(1, 4000)) + "token = a3999 + a1\n"
    assert (6, 14, "literal") in secret_scan.secret_spans(text)
