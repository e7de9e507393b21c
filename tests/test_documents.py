from __future__ import annotations

import json

import pytest

from landfall.sources import documents
from samples import manifest, passenger

GOOD = manifest([passenger("1"), passenger(Age=None, DocumentType=...)])
TEXT = json.dumps(GOOD)


def changed(**changes):
    return json.dumps(manifest(**changes))


CASES = {
    "good": (TEXT, True),
    "no passengers": (changed(passengers=[]), True),
    "surrounding blanks": (f" \n{TEXT}\t\r\n ", True),
    "repeated key, last wins": ('{"EventCode": 5, ' + TEXT[1:], True),
    "nested unknown key": ('{"Extra": {"a": [1, null]}, ' + TEXT[1:], True),
    "empty text": ("", False),
    "empty object": ("{}", False),
    "null": ("null", False),
    "number": ("5", False),
    "array": ("[]", False),
    "document in an array": (f"[{TEXT}]", False),
    "cut off": (TEXT[:-3], False),
    "two documents": (TEXT + TEXT, False),
    "two documents with comma": (f"{TEXT},{TEXT}", False),
    "trailing text": (TEXT + " x", False),
    "trailing brace": (TEXT + "}", False),
    "trailing bracket": (TEXT + "]", False),
    "single quotes": (TEXT.replace('"', "'"), False),
    "not a number": ('{"Extra": NaN, ' + TEXT[1:], False),
    "leading zero": ('{"Extra": 01, ' + TEXT[1:], False),
    "number for text": (changed(EventCode=5), False),
    "null for text": (changed(CarrierCode=None), False),
    "object for text": (changed(CarrierCode={"a": "b"}), False),
    "missing field": (changed(VoyageNumber=...), False),
    "other case": (TEXT.replace("EventCode", "eventcode"), False),
    "missing list": (changed(PassengerList=...), False),
    "null list": (changed(PassengerList=None), False),
    "object for list": (changed(PassengerList={}), False),
    "null passenger": (changed(passengers=[passenger("1"), None]), False),
    "text for passenger": (changed(passengers=["x"]), False),
    "passenger without required": (changed(passengers=[passenger(InTransitFlag=...)]), False),
    "required null": (changed(passengers=[passenger(DocumentIssuingCountryCode=None)]), False),
    "optional null": (changed(passengers=[passenger(Age=None)]), True),
    "optional missing": (changed(passengers=[passenger(Age=...)]), True),
    "optional number": (changed(passengers=[passenger(Age=21)]), False),
    "second passenger bad": (changed(passengers=[passenger("1"), passenger(Age=21)]), False),
}


def test_verdicts(spark):
    frame = spark.createDataFrame([(name, text) for name, (text, _) in CASES.items()], "name string, content string")
    parsed = {r["name"]: r for r in documents.parse(frame).collect()}
    assert {n: r.parse_ok for n, r in parsed.items()} == {n: ok for n, (_, ok) in CASES.items()}
    assert all((r.manifest is not None) == r.parse_ok for r in parsed.values())


def test_values(spark):
    frame = spark.createDataFrame([(TEXT,), ('{"EventCode": 5, ' + TEXT[1:],)], "content string")
    for row in documents.parse(frame).collect():
        m = row.manifest.asDict(recursive=True)
        people = m.pop("PassengerList")
        assert m == {k: GOOD[k] for k in m}
        assert people[0]["PassengerIdentifier"] == "1" and people[0]["Age"] == "22"
        assert people[1]["Age"] is None and people[1]["DocumentType"] is None


@pytest.mark.parametrize("text", ["é", "日本", 'a"b', "\\", " "])
def test_text_is_kept(spark, text):
    frame = spark.createDataFrame([(changed(ArrivalPortCode=text),)], "content string")
    assert documents.parse(frame).first().manifest.ArrivalPortCode == text
