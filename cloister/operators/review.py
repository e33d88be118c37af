"""Advisory reviews of a profile: suggestions that people sign, and questions they answer. No model is called here: a
reply is read from a file. Everything is a small document on the driver but `open_blockers`, which queries many reviews."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vocabularies of a review document, whose checks name their test in the field tests_py_id.
CLASSES = ("direct identifier", "quasi-identifier", "behavioural", "kpi", "unknown")
GUARDED = ("direct identifier", "quasi-identifier")
TESTS = ("T1", "T2", "T3", "T4", "T5", "T6", "T7", "T8", "T9")
DISPOSITIONS = ("accepted", "rejected", "deferred")
ROLES = ("engineer", "data_owner")


class ReviewError(ValueError):
    """A reply or a step that the review can't take; it stays as it was."""


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _need(ok: object, what: str) -> None:
    if not ok:
        raise ReviewError(what)


def _text(x: object) -> bool:
    return isinstance(x, str) and bool(x.strip())


def read_reply(content: str) -> dict:
    """V1: the columns and questions of a reply, held against the rules; a fence around the JSON is taken off."""
    body = content.strip()
    if body.startswith("```"):
        body = body.strip("`").removeprefix("json").strip()
    try:
        reply = json.loads(body)
    except json.JSONDecodeError as e:
        raise ReviewError(f"the reply is not JSON: {e}") from e
    _need(isinstance(reply, dict) and isinstance(reply.get("columns"), list) and reply["columns"], "the reply names no columns")
    seen = set()
    for c in reply["columns"]:
        _need(isinstance(c, dict) and _text(c.get("name")), "a column has no name")
        _need(c["name"] not in seen, f"{c['name']} is there twice")
        seen.add(c["name"])
        _need(c.get("proposed_class") in CLASSES, f"{c['name']}: unknown class")
        _need(_text(c.get("rationale")), f"{c['name']}: no rationale")
        _need(isinstance(c.get("checks"), list) and c["checks"], f"{c['name']}: no checks")
        for check in c["checks"]:
            _need(isinstance(check, dict), f"{c['name']}: a check is no object")
            if check.get("tests_py_id"):
                _need(check["tests_py_id"] in TESTS, f"{c['name']}: unknown test {check['tests_py_id']}")
            else:
                _need(check.get("status") == "not_implemented" and _text(check.get("note")), f"{c['name']}: a check is neither a test nor a note")
    for q in reply.setdefault("open_questions", []):
        _need(isinstance(q, dict) and _text(q.get("text")), "a question has no text")
        _need(isinstance(q.get("must_answer_proposed", False), bool), "must_answer_proposed is no truth value")
    return reply


def assemble(profile: dict, reply: dict, model: str = "offline", host: str = "offline") -> dict:
    """V2: the review of a profile; the reply must name exactly its columns."""
    named = {c["name"]: c for c in reply["columns"]}
    have = [c["name"] for c in profile["columns"]]
    missing, extra = [n for n in have if n not in named], sorted(set(named) - set(have))
    _need(not missing and not extra, f"columns differ from the profile's: missing {missing}, extra {extra}")
    unsigned = {"by": None, "role": None, "at": None}
    columns = [
        {"suggestion_id": f"col:{c['name']}", "name": c["name"], "type": c.get("type"), "description": c.get("description"), "proposed_class": named[c["name"]]["proposed_class"],
         "rationale": named[c["name"]]["rationale"], "checks": named[c["name"]]["checks"], "disposition": "pending", **unsigned}
        for c in profile["columns"]
    ]
    questions = [{"id": f"q{i}", "text": q["text"], "must_answer_proposed": q.get("must_answer_proposed", False), "must_answer": False, "answered": False, "answer": None, **unsigned} for i, q in enumerate(reply["open_questions"], 1)]
    review = {"subject": profile["subject"], "redaction": profile.get("redaction", {}), "model": {"host": host, "name": model, "time": now()}, "profile_sha256": profile.get("profile_sha256"), "columns": columns, "open_questions": questions}
    return review | {"shareable_release_candidate": shareable(review)}


def blockers(review: dict) -> list[str]:
    return [q["id"] for q in review.get("open_questions", []) if q.get("must_answer") and not q.get("answered")]


def shareable(review: dict) -> bool:
    """V3: a release candidate without an unanswered question that must be answered."""
    return review.get("subject") == "release_candidate" and not blockers(review)


def _find(items: list[dict], key: str, value: str) -> dict:
    found = next((x for x in items if x[key] == value), None)
    _need(found is not None, f"no {value} in the review")
    return found


def _signed(item: dict, by: str, role: str, review: dict) -> dict:
    _need(role in ROLES, "unknown role")
    item |= {"by": by, "role": role, "at": now()}
    review["shareable_release_candidate"] = shareable(review)
    return review


def sign(review: dict, suggestion: str, disposition: str, by: str, role: str) -> dict:
    """V4: a person's word on a suggestion; only the data owner accepts what touches identifiers."""
    _need(disposition in DISPOSITIONS, "unknown disposition")
    _need(role in ROLES, "unknown role")
    column = _find(review["columns"], "suggestion_id", suggestion)
    _need(disposition != "accepted" or column["proposed_class"] not in GUARDED or role == "data_owner", f"{suggestion}: the data owner must accept this")
    column["disposition"] = disposition
    return _signed(column, by, role, review)


def must_answer(review: dict, question: str, on: bool, by: str, role: str) -> dict:
    _need(role in ROLES, "unknown role")
    q = _find(review["open_questions"], "id", question)
    q["must_answer"] = bool(on)
    return _signed(q, by, role, review)


def answer(review: dict, question: str, text: str, by: str, role: str) -> dict:
    _need(role in ROLES, "unknown role")
    q = _find(review["open_questions"], "id", question)
    q |= {"answered": True, "answer": text}
    return _signed(q, by, role, review)


def markdown(review: dict) -> str:
    """V5: the review as a page."""
    model = review.get("model", {})
    out = [f"# Privacy review: {review.get('subject')}", "", "Suggestions only; no impact assessment and no proof of anonymity.", "", f"Model {model.get('name')} on {model.get('host')}, {model.get('time')}. Profile {review.get('profile_sha256')}.", f"Shareable: {review.get('shareable_release_candidate')}", "", "| column | class | checks | disposition | by | rationale |", "|-|-|-|-|-|-|"]
    for c in review["columns"]:
        checks = ", ".join(x.get("tests_py_id") or f"none: {x.get('note')}" for x in c["checks"])
        who = f"{c['by']} ({c['role']})" if c.get("by") else "nobody"
        out.append(f"| {c['name']} | {c['proposed_class']} | {checks} | {c['disposition']} | {who} | {c['rationale']} |")
    out += ["", "## Questions", ""]
    for q in review.get("open_questions", []):
        kind = "must be answered" if q.get("must_answer") else "proposed as a must" if q.get("must_answer_proposed") else "optional"
        out.append(f"- {q['id']} ({kind}): {q['text']}" + (f" Answer: {q['answer']}" if q.get("answered") else ""))
    return "\n".join([*out, ""])


def open_blockers(reviews: DataFrame) -> DataFrame:
    """V3 over a table (review_id, subject, open_questions array of structs): (review_id, subject, blockers, shareable)."""
    waiting = F.size(F.filter(F.coalesce("open_questions", F.array().cast(reviews.schema["open_questions"].dataType)), lambda q: q["must_answer"] & ~q["answered"]))
    return reviews.select("review_id", "subject", waiting.cast("long").alias("blockers"), ((F.col("subject") == "release_candidate") & (waiting == 0)).alias("shareable"))


def score_candidates(claims: DataFrame, truth: DataFrame) -> DataFrame:
    """V7: how well claimed candidates (claim, candidate, confidence) meet the truth (claim, candidate): (claims, answered,
    recall, mean_inverse_size, mean_confidence)."""
    sizes = claims.groupBy("claim").agg(F.countDistinct("candidate").alias("n"), F.avg("confidence").alias("c"))
    hits = claims.select("claim", "candidate").distinct().join(truth, ["claim", "candidate"]).select("claim").distinct().withColumn("hit", F.lit(1))
    each = truth.select("claim").distinct().join(sizes, "claim", "left").join(hits, "claim", "left")
    return each.agg(F.count("*").alias("claims"), F.count("n").alias("answered"), F.avg(F.coalesce(F.col("hit").cast("double"), F.lit(0.0))).alias("recall"), F.avg(F.when(F.col("hit") == 1, 1 / F.col("n")).otherwise(0.0)).alias("mean_inverse_size"), F.avg("c").alias("mean_confidence"))
