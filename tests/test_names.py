import pytest

from tabulyst.functions import names


def test_tokens_and_canonical():
    assert names.name_tokens("Pickup Centroid Latitude") == ["pickup", "centroid", "latitude"]
    assert names.canonical_name("Trip_Start Timestamp!") == "tripstarttimestamp"


@pytest.mark.parametrize("name,code", [
    ("zip_code", True), ("Pickup Community Area", True), ("community", False), ("area", False),
    ("centroid", False), ("user_id", True), ("identity", False), ("Census Tract", True),
])
def test_code_like(name, code):
    assert names.is_code_like(name) is code


def test_coordinates():
    assert names.is_coordinate_name("Pickup Centroid Latitude")
    assert not names.is_coordinate_name("population_id")
    # the looser test finds "lat" inside "population"
    assert names.mentions_coordinate("population_id")


def test_time_words_match_inside_words():
    assert names.mentions_time("gender") and names.mentions_time("sentiment")
    assert not names.mentions_time("fare")
    assert names.mentions_time("updated_at")


def test_preferred_column():
    assert names.preferred_column(["x", "payment_type"], ["Payment Type"]) == "payment_type"
    assert names.preferred_column(["x"], ["Payment Type"]) is None


def test_pairs():
    assert not names.is_meaningful_pair("Fare", "Trip Total")
    assert not names.is_meaningful_pair("a", "a")
    assert not names.is_meaningful_pair("lat", "x") and not names.is_meaningful_pair("zip", "x")
    assert names.is_meaningful_pair("Fare", "Trip Miles")


def test_safe_name():
    assert names.safe_name(" Trip Total ($) ") == "Trip_Total"
    assert names.safe_name("¥¥") == "col"
    assert names.safe_name("__a  b__") == "a_b"
    assert len(names.safe_name("x" * 200)) == 80
