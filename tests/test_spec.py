import pytest

from lotwise.plans.spec import JobSpec


def spec(**job):
    return JobSpec(**{"job_name_prefix": "p", "model_id": "m", **job})


def test_strings_are_stripped_and_unknown_keys_kept():
    s = JobSpec.from_mapping({"job_name_prefix": " run ", "model_id": "m ", "s3_uri": " x.csv ", "owner": "me"})
    assert (s.job_name_prefix, s.model_id, s.input_uri) == ("run", "m", "x.csv")
    assert s.extras == {"owner": "me"}


@pytest.mark.parametrize("value", [None, 0, 7])
def test_optional_limits(value):
    assert spec(max_num_jobs=value).max_num_jobs == value


@pytest.mark.parametrize("name", ["max_num_jobs", "max_records_per_job", "max_records_total"])
@pytest.mark.parametrize("value", [-1, "many", "7", 1.5, True])
def test_bad_limits(name, value):
    with pytest.raises(ValueError, match=name):
        spec(**{name: value})


def test_zero_limits():
    with pytest.raises(ValueError):
        spec(max_records_total=0)
    s = spec(max_records_per_job=0, max_num_jobs=0)
    assert s.chunk_size == 1000 and s.row_limit is None


def test_chunk_size_and_total_from_environment(monkeypatch):
    monkeypatch.setenv("MAX_RECORDS_PER_JOB", "250")
    monkeypatch.setenv("MAX_TOTAL_RECORDS", "900")
    s = spec(max_num_jobs=5)
    assert s.chunk_size == 250 and s.row_limit == 900
    assert spec(max_num_jobs=2).row_limit == 500
    monkeypatch.setenv("MAX_TOTAL_RECORDS", " ")
    assert spec().row_limit is None
    for text in ("0", "-3", "ten"):
        monkeypatch.setenv("MAX_TOTAL_RECORDS", text)
        with pytest.raises(ValueError, match="MAX_TOTAL_RECORDS"):
            assert spec().row_limit


def test_exactly_one_source():
    for job in ({}, {"input_uri": "a.csv", "dataset_id": "d"}):
        with pytest.raises(ValueError, match="exactly one"):
            spec(**job).check_source()
    spec(dataset_id="d").check_source()


def test_layout():
    at = spec(root="/data/").layout
    assert at.inputs == "/data/p/inputs" and at.results == "/data/p/results"
