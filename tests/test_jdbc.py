"""How JDBC reads and writes are set up. No database is started, so none is read or written."""

import pytest

from callsieve.sources import jdbc


class Recorder:
    def __init__(self, answers=None):
        self.seen, self.answers = {}, answers
        self.read = self.write = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.answers


def test_read_is_split_into_ranges():
    recorder = Recorder()
    jdbc.jdbc_reader(recorder, "jdbc:x", "calls", "id", 1, 1000, 4, options={"driver": "d"})
    assert recorder.seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "calls", "fetchsize": 10_000, "partitionColumn": "id",
        "lowerBound": 1, "upperBound": 1000, "numPartitions": 4, "driver": "d",
    }


def test_single_range_needs_no_bounds():
    recorder = Recorder()
    jdbc.jdbc_reader(recorder, "jdbc:x", "calls", "id", 1, 1000, 1)
    assert "partitionColumn" not in recorder.seen


def test_bad_ranges_are_refused():
    with pytest.raises(ValueError):
        jdbc.jdbc_reader(Recorder(), "jdbc:x", "calls", "id", 1, 1000, 0)
    with pytest.raises(ValueError):
        jdbc.jdbc_reader(Recorder(), "jdbc:x", "calls", "id", 2, 1, 4)


def test_bounds_come_from_the_database():
    recorder = Recorder(answers=(3, 90))
    assert jdbc.column_bounds(recorder, "jdbc:x", "calls", "id") == (3, 90)
    assert recorder.seen["query"] == "select min(id) as lo, max(id) as hi from calls"
    assert jdbc.column_bounds(Recorder(answers=(None, None)), "jdbc:x", "calls", "id") is None


def test_write_bounds_its_connections():
    recorder = Recorder()
    jdbc.jdbc_writer(recorder, "jdbc:x", "calls", 8, mode="overwrite", options={"user": "u"})
    assert recorder.seen == {
        "format": "jdbc", "mode": "overwrite", "url": "jdbc:x", "dbtable": "calls", "numPartitions": 8,
        "batchsize": 10_000, "user": "u",
    }
