"""Ordered classification rules: the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------------------------------------

# Voting calendar, five groups. North Dakota is listed twice; the earlier group wins.
STATE_GROUPS = (
    ("Early", ("Iowa", "New Hampshire", "South Carolina", "Nevada")),
    (
        "Super Tuesday",
        (
            "Alabama", "Arkansas", "California", "Colorado", "Maine", "Massachusetts", "Minnesota",
            "North Carolina", "Oklahoma", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
        ),
    ),
    ("March 10", ("Idaho", "Michigan", "Mississippi", "Missouri", "North Dakota", "Washington")),
    ("March 14-27", ("Wyoming", "Arizona", "Florida", "Illinois", "Ohio", "Georgia", "North Dakota")),
)
OTHER = "Other"
UNCLASSIFIED = "Unclassified"

# domain, path tests (any may hold; none means every path), page name, page job
PAGE_RULES = (
    ("elizabethwarren.com", {"equals": ["/"]}, "Home", "Gateway"),
    ("elizabethwarren.com", {"prefix": ["/meet-elizabeth"]}, "Meet Elizabeth", "Learn"),
    ("elizabethwarren.com", {"equals": ["/plans", "/plans/"]}, "Plans Gateway", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/plans/"]}, "Plan Detail", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/issues"]}, "Issues", "Learn"),
    (
        "elizabethwarren.com",
        {"contains": ["/calculator"], "prefix": ["/debt", "/kids", "/retirement"]},
        "Calculators",
        "Learn",
    ),
    ("elizabethwarren.com", {"prefix": ["/tax-returns"]}, "Tax Returns", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/faqs"]}, "FAQ", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/wealth-gap"]}, "Wealth Gap (Scrolly Telling)", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/live"]}, "Live", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/watch-live"]}, "Live", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/legal-work"]}, "Legal Work", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/pocahontas"]}, "Pocahontas", "Learn"),
    ("learn.elizabethwarren.com", {}, "learn.ew domain (all)", "Learn"),
    ("elizabethwarren.com", {"prefix": ["/join-us"]}, "Join Us", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/all-in-for-warren"]}, "All In For Warren", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/take-action"]}, "Take Action", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/volunteer"]}, "Volunteer", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/toolkit"]}, "Toolkit", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/call"]}, "Call", "Volunteer"),
    ("elizabethwarren.com", {"prefix_any_case": ["/roadwarriors"]}, "Road Warriors", "Volunteer"),
    ("events.elizabethwarren.com", {"equals": ["/"]}, "events.ew: Events Gateway", "Volunteer"),
    ("events.elizabethwarren.com", {"prefix": ["/event/"]}, "events.ew: Event Detail", "Volunteer"),
    ("events.elizabethwarren.com", {}, "events.ew: Other", "Volunteer"),
    ("switchboard.elizabethwarren.com", {}, "Switchboard", "Volunteer"),
    ("elizabethwarren.com", {"prefix": ["/jobs"]}, "Jobs", "Volunteer"),
    ("join.elizabethwarren.com", {}, "join.ew domain (all)", "Volunteer"),
    ("donate.elizabethwarren.com", {}, "donate.ew domain (all)", "Donate"),
    ("elizabethwarren.com", {"prefix": ["/thanks-for-donating"]}, "Thanks For Donating", "Donate"),
    ("elizabethwarren.com", {"prefix": ["/give-by-mail"]}, "Give By Mail", "Donate"),
    ("secure.actblue.com", {}, "ActBlue", "Donate"),
    ("caucus-app.elizabethwarren.com", {}, "caucus-app.ew domain (all)", "GOTV/C"),
    ("elizabethwarren.com", {"prefix": ["/vote"]}, "Polling Locator", "GOTV/C"),
    ("elizabethwarren.com", {"prefix": ["/pledge"]}, "Pledge", "GOTV/C"),
    ("shop.elizabethwarren.com", {}, "Shop", "Shop"),
    ("elizabethwarren.com", {"prefix": ["/es"]}, "En Espanol (all ew.com/es/)", "Miscellaneous"),
    (
        "elizabethwarren.com",
        {"prefix": ["/privacy-policy", "/terms-of-service"]},
        "Privacy Policy, TOS",
        "Miscellaneous",
    ),
    ("elizabethwarren.com", {"prefix": ["/contact-us"]}, "Contact Us", "Miscellaneous"),
    ("elizabethwarren.com", {"prefix": ["/grassroots-donor-wall"]}, "Grassroots Donor Wall", "Miscellaneous"),
    ("facts.elizabethwarren.com", {}, "Fact Squad", "Miscellaneous"),
    (
        "my.elizabethwarren.com",
        {"contains": ["unsubscribe"], "equals": ["/page/s/less-email", "/page/st/less-email"]},
        "Email Unsubscribe / Reduce",
        "Miscellaneous",
    ),
    (
        "my.elizabethwarren.com",
        {"contains": ["/page/s/", "/page/st/", "/page/sp/"]},
        "Surveys / Petitions / Contests",
        "Miscellaneous",
    ),
    ("my.elizabethwarren.com", {}, "Other my.ew.com", "Miscellaneous"),
)

# Marketing channels in the order of their rules.
CHANNEL_LABELS = (
    "Paid Search", "Display", "Paid Direct Buy", "Paid Direct Buy", "Paid Social", "Email", "Affiliate", "Organic Search",
    "Organic Social", "SMS", "Unknown Channel", "Direct", "Internal Transfer",
)

# --- End of fixed values ----------------------------------------------------------------------------------------

# Page templates report the first two voting groups only.
PAGE_STATE_GROUPS = STATE_GROUPS[:2]

# SQL conditions of the default channel rules, one for each label, over the columns of ``with_channel_inputs``: lower
# case, empty when missing. The conditions are this library's choice and meant to be replaced.
CHANNEL_CONDITIONS = (
    "utm_medium = 'cpc' or publisher = 'google'",
    "utm_medium = 'display'",
    "startswith(source, 'ads-')",
    "utm_medium = 'direct-buy'",
    "publisher in ('facebook', 'instagram')",
    "utm_medium = 'email' or startswith(source, 'em-')",
    "utm_medium = 'affiliate'",
    "startswith(referrer_host, 'google.') or contains(referrer_host, '.google.') "
    "or startswith(referrer_host, 'bing.') or contains(referrer_host, '.bing.')",
    "utm_medium = 'social' or referrer_host in ('t.co', 'facebook.com') "
    "or endswith(referrer_host, '.facebook.com') or startswith(source, 'soc-')",
    "utm_medium = 'sms' or startswith(source, 'sms-')",
    "source <> ''",
    "referrer = '' and utm_medium = '' and utm_source = ''",
    "referrer_host in ('secure.actblue.com', 'shop.elizabethwarren.com')",
)
CHANNEL_RULES = tuple(zip(CHANNEL_LABELS, CHANNEL_CONDITIONS, strict=True))


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first rule whose condition holds. A NULL condition does not hold."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        return F.lit(otherwise)
    return chain.otherwise(otherwise)


def any_of(conditions: Iterable[Column]) -> Column:
    """Whether one of the conditions holds; none does if there are none."""
    held = list(conditions)
    return reduce(or_, held) if held else F.lit(False)


def sql_text(value: str | None) -> str:
    """Spark SQL literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_array(values: Iterable[str | None]) -> str:
    return f"array({', '.join(map(sql_text, values))})"


# Rule sets of any length become one SQL expression each: building the same expression Column by
# Column costs the driver a round trip to the JVM per condition.


def state_group(region: str = "region", groups: Sequence = STATE_GROUPS) -> Column:
    """Group of a region; a region listed twice belongs to the earlier group."""
    group_of: dict[str, str] = {}
    for label, regions in groups:
        for name in regions:
            group_of.setdefault(name, label)
    entries = ", ".join(f"{sql_text(name)}, {sql_text(label)}" for name, label in group_of.items())
    return F.expr(f"coalesce(element_at(map({entries}), {region}), {sql_text(OTHER)})")


_PATH_TESTS = {
    "equals": "{path} = {pattern}",
    "prefix": "startswith({path}, {pattern})",
    "prefix_any_case": "startswith(lower({path}), lower({pattern}))",
    "contains": "contains({path}, {pattern})",
}


def _path_test(path: str, tests: Mapping[str, Sequence[str]]) -> str:
    checks = [
        _PATH_TESTS[kind].format(path=path, pattern=sql_text(p)) for kind, patterns in tests.items() for p in patterns
    ]
    return " or ".join(checks) or "true"


def page_rule_no(domain: str = "domain", path: str = "path", rules: Sequence = PAGE_RULES) -> Column:
    """1-based number of the first page rule that matches, 0 for none. A NULL path meets no path test.

    Rules of different domains exclude each other, so the chain is split by domain first: a row is
    compared with the paths of its own domain only.
    """
    by_domain: dict[str, list[str]] = {}
    for number, (rule_domain, tests, _, _) in enumerate(rules, start=1):
        by_domain.setdefault(rule_domain, []).append(f"when {_path_test(path, tests)} then {number}")
    arms = [f"when {sql_text(name)} then case {' '.join(tests)} else 0 end" for name, tests in by_domain.items()]
    return F.expr(f"case {domain} {' '.join(arms)} else 0 end")


def _label(rule_no: str, labels: Sequence[str]) -> Column:
    return F.expr(f"try_element_at({sql_array([UNCLASSIFIED, *labels])}, {rule_no} + 1)")


def page_name(rule_no: str = "page_rule_no", rules: Sequence = PAGE_RULES) -> Column:
    return _label(rule_no, [r[2] for r in rules])


def page_job(rule_no: str = "page_rule_no", rules: Sequence = PAGE_RULES) -> Column:
    return _label(rule_no, [r[3] for r in rules])


def channel(rules: Sequence = CHANNEL_RULES) -> Column:
    """Marketing channel from the columns that ``with_channel_inputs`` prepares."""
    arms = [f"when {condition} then {sql_text(label)}" for label, condition in rules]
    return F.expr(f"case {' '.join(arms)} else {sql_text(OTHER)} end")
