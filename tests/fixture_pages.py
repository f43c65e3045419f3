"""Hand-made pages: one clean review and one mutation of it per rule."""

from __future__ import annotations

import copy
import json

# A review that passes all rules.
BASE = {
    "recommendationid": "900",
    "author": {"steamid": "76500000000000001", "num_games_owned": 12, "num_reviews": 3,
               "playtime_forever": 600, "playtime_last_two_weeks": 30, "playtime_at_review": 550,
               "last_played": 1767225600},
    "language": "english", "review": "solid", "timestamp_created": 1767225600,
    "timestamp_updated": 1767225700, "voted_up": True, "votes_up": 4, "votes_funny": 0,
    "weighted_vote_score": "0.52", "comment_count": 1, "steam_purchase": True,
    "received_for_free": False, "written_during_early_access": False,
    "primarily_steam_deck": False, "reactions": [{"reaction_type": 31, "count": 2}],
}

MISSING = {"recommendationid": "review:miss_review_id", "review": "review:miss_review_text",
           "language": "review:miss_language", "timestamp_created": "review:miss_timestamp_created",
           "voted_up": "review:miss_voted_up"}
BAD = {
    **{c: "not-a-time" for c in ("timestamp_created", "timestamp_updated",
                                 "timestamp_dev_responded")},
    **{c: "maybe" for c in ("voted_up", "steam_purchase", "received_for_free",
                            "written_during_early_access", "primarily_steam_deck")},
    **{c: "many" for c in ("votes_up", "votes_funny", "comment_count")},
    "weighted_vote_score": "0.5abc", "reactions": "[bad",
}
BAD_AUTHOR = {
    **{c: "lots" for c in ("num_games_owned", "num_reviews", "playtime_forever",
                           "playtime_last_two_weeks", "playtime_at_review",
                           "deck_playtime_at_review")},
    "last_played": "yesterday",
}


def review(**changes) -> dict:
    """The base review; ``author=`` changes members, a value of ``...`` removes a field."""
    made = copy.deepcopy(BASE)
    author = changes.pop("author", {})
    for target, values in ((made, changes), (made["author"], author)):
        for name, value in values.items():
            if value is ...:
                target.pop(name, None)
            else:
                target[name] = value
    return made


def page(reviews: list[dict], app_id: int | None = 730, cursor: str = "c1", **summary) -> str:
    doc = {"success": 1, "query_summary": {"num_reviews": len(reviews), **summary},
           "reviews": reviews, "cursor": cursor}
    if app_id is not None:
        doc["app_id"] = app_id
    return json.dumps(doc, ensure_ascii=False)


def rule_pages() -> dict[str, str]:
    """Expected reason to the page that breaks only this rule (empty reason: the clean page)."""
    pages = {"": page([review()])}
    for name, reason in MISSING.items():
        pages[reason] = page([review(**{name: ...})])
    pages["review:miss_app_id"] = page([review()], app_id=None)
    for name, text in BAD.items():
        pages[f"review:{name}_malformed"] = page([review(**{name: text})])
    pages["author:miss_author_steam_id"] = page([review(author={"steamid": ...})])
    for name, text in BAD_AUTHOR.items():
        pages[f"author:{name}_malformed"] = page([review(author={name: text})])
    return pages
