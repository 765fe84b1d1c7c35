from tests.llm.conftest import prose

from tidemark.llm.licence_scan import LicenceRules, scan_licences
from tidemark.llm.licence_templates import TEMPLATES

RULES = LicenceRules(iterations=25, variants=6)


def scan(docs):
    return {r.doc_id: r for r in scan_licences(docs, RULES).collect()}


def test_notices_are_found_and_prose_is_not(documents):
    rows = [(i, prose(i, 60)) for i in range(60)]
    noted = {100 + i: family for i, (family, _) in enumerate(TEMPLATES)}
    rows += [(100 + i, f"{prose(i, 20)}\n{text}\n{prose(i + 1, 20)}") for i, (_, text) in enumerate(TEMPLATES)]
    rows += [(300, "Released under the MIT license!"), (301, "She renewed her driving license yesterday.")]
    rows += [(302, "licensed under the apache license, version 2.0"), (303, "The general public came in version 3.")]
    found = scan(documents(rows))
    assert not any(found[i].n_confirmed for i in range(60))
    right = sum(family in found[i].families.split(",") for i, family in noted.items())
    assert right >= 0.9 * len(noted)
    assert found[300].families == "mit" and found[302].families == "apache"
    assert found[301].families == found[303].families == ""
    assert found[300].notices == "0:mit"


def test_odd_rows(documents, odd_rows):
    got = scan_licences(documents(odd_rows), RULES).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
    assert all(r.n_paragraphs == 0 for r in got if r.doc_id in (1, 2, 3))


def test_native(documents, odd_rows):
    plan = scan_licences(documents(odd_rows), RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(documents):
    assert scan_licences(documents([]), RULES).count() == 0
