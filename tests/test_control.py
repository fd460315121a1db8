import pytest

from groovemill.errors import InvalidArgument
from groovemill.functions.strict_json import strict_object
from groovemill.plans.progress import Reporter, retrying


def test_reports_are_throttled_and_errors_dont_stop():
    now, seen, state = [0.0], [], {"done": 0}
    r = Reporter("artist", lambda: (state["done"], 10), seen.append, clock=lambda: now[0])
    r.start()
    now[0], state["done"] = 4.0, 4
    assert not r.report_if_due()
    now[0] = 5.0
    assert r.report_if_due() and not r.report_if_due()
    del state["done"]
    r.finish(True)
    assert [x["state"] for x in seen] == ["started", "running", "observation_error"] and seen[1]["percent"] == 40.0
    state["done"] = 10
    r.finish(False)
    assert seen[-1]["state"] == "failed"


def test_retries():
    tries, pauses = [], []

    def step():
        tries.append(1)
        if len(tries) < 4:
            raise OSError
        return "ok"

    assert retrying(step, (OSError,), sleep=pauses.append) == "ok" and len(pauses) == 3
    assert 0.05 <= pauses[0] <= 0.15 and 0.35 <= pauses[2] <= 0.45
    tries.clear()

    def never():
        tries.append(1)
        raise OSError

    with pytest.raises(OSError):
        retrying(never, (OSError,), sleep=lambda s: None)
    assert len(tries) == 6


def test_strict_objects():
    assert strict_object('{"a": 1, "b": [2]}', ["a", "b"]) == {"a": 1, "b": [2]}
    for bad in ('{"a": 1, "a": 2}', '{"a": 1}', '{"a": 1, "b": 2, "c": 3}', "[1]", "nope", '{"a": NaN, "b": 1}', '{"a": ' + "[" * 40 + "]" * 40 + ', "b": 1}', " " * 1_000_001, '{"a": ' + "[" * 100_000):
        with pytest.raises(InvalidArgument):
            strict_object(bad, ["a", "b"])
