"""Prose about credentials is no secret; values that only credential contexts have are."""

import pytest

from ordertide.llm import secrets


@pytest.mark.parametrize("text", [
    "The password is incorrect.", "Your token is invalid!", "The secret is patience.", "passphrase is required", "password: missing",
    "the api key is available, the access key is different", "token: identifier", "credentials: username/password"])
def test_clean_prose(text):
    assert secrets.find_secrets(text) == []
    assert secrets.redacted(text, secrets.find_secrets(text)) == text


def test_values_stay_secrets():
    for value in ("xK9#vQ2$mZ", "tR7wq0Lp3n", "xkqjwzrtpv", "Zr4-plQx-88vW", "correctplanetwindowriver"):
        assert [f[2] for f in secrets.find_secrets(f"pwd: {value}")] == ["guess"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_words_of_the_table_are_common(spark):
    prose = [f"Many a Zorblewick went by, number {i}." for i in range(secrets.MIN_DOCS)]
    asked = ["its password is zorblewick, he said", "its password is vormplenack, he said"]
    leaked = ["passphrase is vormplenack"] * 20  # in credential contexts alone
    red = {r.doc_id: r.text for r in secrets.redact_secrets(frame(spark, asked + prose + leaked)).collect()}
    assert red[0] == asked[0] and red[1] == "its password is <guess>, he said" and red[20] == "passphrase is <guess>"
    few = secrets.scan_secrets(frame(spark, asked + prose[1:])).orderBy("doc_id").collect()
    assert [r.n_guess for r in few[:3]] == [1, 1, 0]


def test_kept_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(secrets, "WORDS_KEPT", 3)
    texts = ["zorba zorbb zorbc" + " zorbd" * (i < 6) + " zorbe" * (i < 6) for i in range(40)]
    ranks = secrets.word_ranks(frame(spark, texts))
    assert set(ranks) - set(secrets.RANK) == {"zorba", "zorbb", "zorbc"} and ranks["zorbb"] == 2
    assert secrets.word_ranks(frame(spark, texts).limit(0)) == secrets.RANK
