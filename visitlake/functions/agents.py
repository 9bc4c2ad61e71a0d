"""User agent text -> browser and operating system, by an ordered rule table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.text import is_blank
from visitlake.schema import UNKNOWN


@dataclass(frozen=True)
class AgentRule:
    """`marker` must occur for the rule to apply; `pattern` group 1, if any, is the version.

    `label` is the text put before the version in the operating system's full name; rules without a
    pattern use it as the full name.
    """

    marker: str
    name: str
    pattern: str = ""
    label: str = ""


# First rule whose marker occurs in the text wins, so more specific products come first.
BROWSER_RULES = [
    AgentRule("Googlebot", "Googlebot", r"Googlebot/([0-9.]+)"),
    AgentRule("bingbot", "bingbot", r"bingbot/([0-9.]+)"),
    AgentRule("Baiduspider", "Baiduspider", r"Baiduspider/([0-9.]+)"),
    AgentRule("YandexBot", "YandexBot", r"YandexBot/([0-9.]+)"),
    AgentRule("DuckDuckBot", "DuckDuckBot", r"DuckDuckBot/([0-9.]+)"),
    AgentRule("Slurp", "Yahoo Slurp"),
    AgentRule("Sogou web spider", "Sogou web spider", r"Sogou web spider/([0-9.]+)"),
    AgentRule("360Spider", "360Spider"),
    AgentRule("Applebot", "Applebot", r"Applebot/([0-9.]+)"),
    AgentRule("AhrefsBot", "AhrefsBot", r"AhrefsBot/([0-9.]+)"),
    AgentRule("SemrushBot", "SemrushBot", r"SemrushBot/([0-9.]+)"),
    AgentRule("PetalBot", "PetalBot"),
    AgentRule("Bytespider", "Bytespider"),
    AgentRule("facebookexternalhit", "Facebook", r"facebookexternalhit/([0-9.]+)"),
    AgentRule("Twitterbot", "Twitterbot", r"Twitterbot/([0-9.]+)"),
    AgentRule("MicroMessenger", "WeChat", r"MicroMessenger/([0-9.]+)"),
    AgentRule("UCBrowser", "UC Browser", r"UCBrowser/([0-9.]+)"),
    AgentRule("MQQBrowser", "QQ Browser", r"MQQBrowser/([0-9.]+)"),
    AgentRule("QQBrowser", "QQ Browser", r"QQBrowser/([0-9.]+)"),
    AgentRule("MetaSr", "Sogou Explorer", r"MetaSr ([0-9.]+)"),
    AgentRule("Maxthon", "Maxthon", r"Maxthon[ /]([0-9.]+)"),
    AgentRule("YaBrowser", "Yandex.Browser", r"YaBrowser/([0-9.]+)"),
    AgentRule("Vivaldi", "Vivaldi", r"Vivaldi/([0-9.]+)"),
    AgentRule("SamsungBrowser", "Samsung Browser", r"SamsungBrowser/([0-9.]+)"),
    AgentRule("HuaweiBrowser", "Huawei Browser", r"HuaweiBrowser/([0-9.]+)"),
    AgentRule("MiuiBrowser", "Miui Browser", r"MiuiBrowser/([0-9.]+)"),
    AgentRule("QihooBrowser", "360 Browser", r"QihooBrowser/([0-9.]+)"),
    AgentRule("360SE", "360 Browser"),
    AgentRule("EdgA/", "Edge Mobile", r"EdgA/([0-9.]+)"),
    AgentRule("EdgiOS/", "Edge Mobile", r"EdgiOS/([0-9.]+)"),
    AgentRule("Edge/", "Edge", r"Edge/([0-9.]+)"),
    AgentRule("Edg/", "Edge", r"Edg/([0-9.]+)"),
    AgentRule("OPR/", "Opera", r"OPR/([0-9.]+)"),
    AgentRule("Opera Mini", "Opera Mini", r"Opera Mini/([0-9.]+)"),
    AgentRule("Opera", "Opera", r"Opera[/ ](?:9\.80.*Version/)?([0-9.]+)"),
    AgentRule("Chromium", "Chromium", r"Chromium/([0-9.]+)"),
    AgentRule("HeadlessChrome", "Headless Chrome", r"HeadlessChrome/([0-9.]+)"),
    AgentRule("CriOS", "Chrome Mobile", r"CriOS/([0-9.]+)"),
    AgentRule("FxiOS", "Firefox Mobile", r"FxiOS/([0-9.]+)"),
    AgentRule("Chrome/", "Chrome", r"Chrome/([0-9.]+)"),
    AgentRule("SeaMonkey", "SeaMonkey", r"SeaMonkey/([0-9.]+)"),
    AgentRule("Firefox/", "Firefox", r"Firefox/([0-9.]+)"),
    AgentRule("MSIE", "IE", r"MSIE ([0-9.]+)"),
    AgentRule("Trident/", "IE", r"rv:([0-9.]+)"),
    AgentRule("Android", "Android browser", r"Version/([0-9.]+)"),
    AgentRule("Mobile/", "Mobile Safari", r"Version/([0-9.]+)"),
    AgentRule("Safari/", "Safari", r"Version/([0-9.]+)"),
    AgentRule("curl/", "cURL", r"curl/([0-9.]+)"),
    AgentRule("Wget/", "Wget", r"Wget/([0-9.]+)"),
]

OS_RULES = [
    AgentRule("Windows Phone", "Windows Phone", r"Windows Phone (?:OS )?([0-9.]+)", "Windows Phone "),
    AgentRule("Windows NT 10.0", "Windows", "", "Windows 10"),
    AgentRule("Windows NT 6.3", "Windows", "", "Windows 8.1"),
    AgentRule("Windows NT 6.2", "Windows", "", "Windows 8"),
    AgentRule("Windows NT 6.1", "Windows", "", "Windows 7"),
    AgentRule("Windows NT 6.0", "Windows", "", "Windows Vista"),
    AgentRule("Windows NT 5.2", "Windows", "", "Windows 2003 Server"),
    AgentRule("Windows NT 5.1", "Windows", "", "Windows XP"),
    AgentRule("Windows NT 5.0", "Windows", "", "Windows 2000"),
    AgentRule("Windows", "Windows", "", "Windows"),
    AgentRule("iPhone", "iOS", r"OS ([0-9_]+) like Mac", "iOS "),
    AgentRule("iPad", "iOS", r"OS ([0-9_]+) like Mac", "iOS "),
    AgentRule("iPod", "iOS", r"OS ([0-9_]+) like Mac", "iOS "),
    AgentRule("Mac OS X", "OS X", r"Mac OS X ([0-9_.]+)", "OS X "),
    AgentRule("Macintosh", "Mac OS", "", "Mac OS"),
    AgentRule("HarmonyOS", "HarmonyOS", r"HarmonyOS ([0-9.]+)", "HarmonyOS "),
    AgentRule("Android", "Android", r"Android ([0-9.]+)", "Android "),
    AgentRule("CrOS", "Chrome OS", "", "Chrome OS"),
    AgentRule("Ubuntu", "Linux", "", "Linux (Ubuntu)"),
    AgentRule("Linux", "Linux", "", "Linux"),
    AgentRule("FreeBSD", "BSD", "", "FreeBSD"),
    AgentRule("SymbianOS", "Symbian OS", "", "Symbian OS"),
    AgentRule("J2ME", "JVM", "", "JVM"),
]


def rule_number(agent: Column, rules: list[AgentRule]) -> Column:
    """Place of the first rule whose marker occurs in the text; as many as there are rules if none does."""
    chosen = F.lit(len(rules))
    for k, rule in reversed(list(enumerate(rules))):
        chosen = F.when(agent.contains(rule.marker), k).otherwise(chosen)
    return chosen


def _by_rule(number: Column, values: dict[int, Column], default: Column) -> Column:
    chosen = None
    for k, value in values.items():
        chosen = F.when(number == k, value) if chosen is None else chosen.when(number == k, value)
    return default if chosen is None else chosen.otherwise(default)


def with_user_agent(
    df: DataFrame,
    agent_col: str,
    into: str = "agent",
    browser_rules: list[AgentRule] = BROWSER_RULES,
    os_rules: list[AgentRule] = OS_RULES,
) -> DataFrame:
    """Adds the struct `into` (browser, browser_v, os, os_v), null for blank text.

    The rules that apply are found once per row, as a column of their own; names are taken from arrays by their numbers and
    only the patterns of those rules run. Text no rule knows has `unknown` names and no browser version.
    """
    agent, browser, os = F.col(agent_col), F.col("_browser_rule"), F.col("_os_rule")
    numbered = df.withColumns({"_browser_rule": rule_number(agent, browser_rules), "_os_rule": rule_number(agent, os_rules)})

    def names(rules: list[AgentRule], number: Column, full: bool = False) -> Column:
        texts = [r.label if full and not r.pattern else r.name for r in rules]
        return F.get(F.array(*[F.lit(t) for t in (*texts, UNKNOWN)]), number)

    versions = _by_rule(
        browser, {k: F.regexp_extract(agent, r.pattern, 1) for k, r in enumerate(browser_rules) if r.pattern}, F.lit("")
    )
    numbers = {
        k: F.translate(F.regexp_extract(agent, r.pattern, 1), "_", ".") for k, r in enumerate(os_rules) if r.pattern
    }
    labels = {k: F.concat(F.lit(os_rules[k].label), F.nullif(n, F.lit(""))) for k, n in numbers.items()}
    full_name = F.coalesce(_by_rule(os, labels, F.lit(None).cast("string")), names(os_rules, os, True))
    parsed = F.struct(
        names(browser_rules, browser).alias("browser"), F.nullif(versions, F.lit("")).alias("browser_v"),
        names(os_rules, os).alias("os"), full_name.alias("os_v"),
    )
    return numbered.withColumn(into, F.when(~is_blank(agent), parsed)).drop("_browser_rule", "_os_rule")
