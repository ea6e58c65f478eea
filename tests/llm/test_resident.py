"""A worker process holds one cache at a time."""

from kvlens.llm import resident


def test_one_object_is_held():
    resident.release()
    made = []

    def make(x):
        return lambda: made.append(x) or [x]

    first = resident.resident(("a", 1), make("a"))
    assert resident.resident(("a", 1), make("again")) is first
    assert resident.resident(("b", 1), make("b")) == ["b"]
    assert list(resident._HELD) == [("b", 1)]
    assert resident.resident(("a", 1), make("a")) is not first
    assert made == ["a", "b", "a"]
    resident.release()
    resident.release()
    assert not resident._HELD


def test_nothing_is_an_object_too():
    resident.release()
    calls = []
    for _ in range(2):
        assert resident.resident("none", lambda: calls.append(1)) is None
    assert calls == [1]
    resident.release()
