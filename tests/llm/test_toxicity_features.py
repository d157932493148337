"""Features of single texts."""

import pytest

from tallywood.llm.toxicity import FEATURES, features

LEXICON = {"shit": 2.0, "ass": 1.5, "idiot": 1.0}


def of(text):
    return dict(zip(FEATURES, features(text, LEXICON), strict=True))


@pytest.mark.parametrize("text", ["$hit", "($hit)", "a$$", "a$$!", "@ss,", "!diot", "1diot", "“a$$”"])
def test_disguise_at_the_edges(text):
    got = of(f"what {text} there")
    assert got["disguised_hits"] == pytest.approx(1 / 3) and got["lexicon_density"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("text", ["hello!", "4th", "$100", "100$", "*bold*", "idiot!", "'idiot'", "r2d2"])
def test_no_disguise(text):
    assert of(f"what {text} there")["disguised_hits"] == 0


def test_second_persons_without_a_hit():
    got = of("you and your house")
    assert got["second_person_density"] == 0.5 and got["near_second_person"] == 0


@pytest.mark.parametrize("text", ["ТЫ ДУРАК", "ΝΑ ΒΛΑΚΑ", "ÉÈ ÀÂÇ"])
def test_shouting_in_any_script(text):
    got = of(text)
    assert got["capitals"] == 1 and got["shouted_words"] == 0.5
    assert of(text.lower())["capitals"] == 0 and of("ΟΚ and NO!")["shouted_words"] == pytest.approx(1 / 3)
