"""Candidates and checks have no bound but the digits themselves."""

from logharbor.llm import pii


def test_card_digit_by_digit_is_proposed():
    card = " ".join("4111111111111111")
    text = f"pay {card} 12345678 now"
    assert ("card", 4, 4 + len(card)) in pii.candidates(text)
    phone = "+" + " ".join("491711234567")
    assert ("phone", 0, len(phone)) in pii.candidates(phone + " 4111")


def test_zero_padded_address_is_valid():
    padded = "0" * 500
    assert pii.valid("ip", f"{padded}10.0.0.{padded}") and pii.valid("ip", "255.255.255.255")
    assert not pii.valid("ip", f"{padded}256.0.0.1") and not pii.valid("ip", "1" * 5000 + ".0.0.1")
    assert pii.base_spans(f"at {padded}7.1.2.3")[0] == [("ip", 3, 3 + 507)]
