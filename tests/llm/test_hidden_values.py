"""Personal data beside other digits, which one greedy form would take together and then let pass."""

import pytest

from tidemark.llm.pseudonyms import replace_personal_data

CARD, PHONE, SSN = "4111 1111 1111 1111", "555-123-4567", "123-45-6789"


def replaced(spark, *texts):
    return [r[0] for r in replace_personal_data(spark.createDataFrame([(t,) for t in texts], "text string"), "k").collect()]


@pytest.mark.parametrize("value,texts", [
    (CARD, [f"{CARD} 12/27", f"{CARD} 123", f"12 {CARD}", f"1234 {CARD}", f"1 2 {CARD} 3 4", f"{CARD} {CARD}", f"1234567890123 {CARD}"]),
    ("4111111111111111", ["4111111111111111 123", "12 4111111111111111", "1234-4111111111111111-99", "7 4111111111111111 12/27"]),
    ("3782 822463 10005", ["3782 822463 10005 1234", "99 3782 822463 10005"]),
    (PHONE, [f"12345 {PHONE}", f"1234567 {PHONE} 12", f"{PHONE} 12345", f"{CARD} {PHONE}"]),
    (SSN, [f"1234567 {SSN}", f"{SSN} 1234567", f"{CARD} {SSN}"]),
    ("2001-02-03", ["123456 2001-02-03 12", f"{CARD} 2001-02-03"]),
    ("10.1.2.3", ["123456789012 10.1.2.3"]),
    ("12345@mail.com", ["4111 1111 1234 12345@mail.com"]),
])
def test_values_beside_digits(spark, value, texts):
    new, *found = replaced(spark, value, *texts)
    assert new != value
    cards = {c: n for c, n in zip((CARD, PHONE, SSN), replaced(spark, CARD, PHONE, SSN), strict=True)} | {value: new}
    for text, out in zip(texts, found, strict=True):
        expected = text
        for old, changed in cards.items():
            expected = expected.replace(old, changed)
        assert out == expected and value not in out
