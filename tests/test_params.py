import pytest

from footfall import schemas
from footfall.params import JobParams, load_params

TEXT = """{"startDate":["2024-01-01","2025-01-01"],"endDate":["2024-01-31"],"startAge":["10"],
"endAge":[50],"professsionals":["a,b"],"cities":["x"],"sex":["male"],"keywords":["k1, k2"],
"categoryIds":["1,22"],"targetPageFlow":["1,2,3"]}"""


def test_first_value_of_each_key_counts():
    p = JobParams.from_json(TEXT, 7)
    assert p == JobParams(
        7, "2024-01-01", "2024-01-31", 10, 50, ["a", "b"], ["x"], "male", ["k1", "k2"], [1, 22], [1, 2, 3]
    )


def test_current_spelling_wins():
    assert JobParams.from_json('{"professionals":["c"],"professsionals":["a"]}').professionals == ["c"]


@pytest.mark.parametrize("text", ["", "{}", '{"sex":[],"keywords":[""],"startAge":null}'])
def test_absent_parameters(text):
    assert JobParams.from_json(text) == JobParams()


def test_task_lookup(spark):
    tasks = spark.createDataFrame(
        [(1, "a", "", "", "", "", "", "{}"), (2, "b", "", "", "", "", "", TEXT)], schemas.TASK
    )
    assert load_params(tasks, 2) == JobParams.from_json(TEXT, 2)
    with pytest.raises(LookupError):
        load_params(tasks, 3)
