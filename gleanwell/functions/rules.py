"""Text rules: which posts count as spam or low effort.

All lists are substring tests on the lower-cased text, so "hen" also hits "when". That is the
meaning the results depend on; ``whole_words=True`` is the stricter reading.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words below decide which posts are dropped.
LOOSE_SPAM = ["airdrop", "token", "coin"]
LOW_EFFORT_PREFIXES = ["gm", "gn", "good morning", "good night", "happy"]
CRYPTO_WORDS = [
    "crypto", "blockchain", "defi", "nft", "airdrop", "mint", "whitelist", "presale", "ico",
    "token", "coin", "hodl", "moon", "pump", "dump", "wagmi", "gm ser", "lfg", "dyor", "fomo",
    "fud", "ape", "degen", "yield farm", "liquidity pool", "staking", "rug", "scam", "moxie",
    "win", "farcaster", "neynar", "warpcast", "farcon", "tribe", "ctg", "farhack", "rewards",
]
ANIMAL_WORDS = [
    "egg", "eggs", "cock", "hen", "hens", "chicken", "rooster", "cluck", "lay egg", "laid egg",
]
GAMBLING_WORDS = [
    "spin", "warpslot", "slot", "casino", "lottery", "jackpot", "won", "win big", "free spin",
    "daily spin", "spin to win", "lucky", "fortune",
]
FARMING_WORDS = [
    "follow me", "follow back", "recast", "like and recast", "share to win", "tag friends",
    "follow for follow", "f4f",
]
FEATURE_SPAM = ["airdrop", "claim", "giveaway", "free", "check eligibility"]
SHORT_CLAIM_BELOW = 100
CASHTAG = r"\$[A-Z]{2,}"
CASHTAG_WHOLE_TEXT = r"(?s)\A%\$[A-Z]{2,}%\z"

SPAM_LISTS = {
    "crypto": CRYPTO_WORDS,
    "animal": ANIMAL_WORDS,
    "gambling": GAMBLING_WORDS,
    "farming": FARMING_WORDS,
}


def needed_words(words: Sequence[str]) -> list[str]:
    """Drop every word that contains another one: the shorter word already decides."""
    unique = list(dict.fromkeys(words))
    return [w for w in unique if not any(v != w and v in w for v in unique)]


def _shared_starts(words: Sequence[str]) -> str:
    """A pattern for any of the words in which common beginnings are tried only once."""
    if "" in words:
        return ""
    tails: dict[str, list[str]] = {}
    for w in words:
        tails.setdefault(w[0], []).append(w[1:])
    branches = [re.escape(c) + _shared_starts(rest) for c, rest in tails.items()]
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def _any_word(words: Sequence[str], whole_words: bool) -> str:
    """One pattern for a word list. A look at the first letter skips most text positions."""
    if whole_words:
        inner = "|".join(re.escape(w) for w in dict.fromkeys(words))
        return rf"(?<!\w)(?:{inner})(?!\w)"
    needed = needed_words(words)
    first = "".join(sorted({re.escape(w[0]) for w in needed}))
    return f"(?=[{first}]){_shared_starts(needed)}"


def mentions_any(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """True where the lower-cased text contains one of the words."""
    return F.lower(text).rlike(_any_word(words, whole_words))


def low_effort(text: Column) -> Column:
    """True where the lower-cased text starts with a greeting."""
    return F.lower(text).rlike(r"\A(?:" + "|".join(LOW_EFFORT_PREFIXES) + ")")


def short_claim(text: Column) -> Column:
    """True for a short text that mentions a claim."""
    return (F.length(text) < SHORT_CLAIM_BELOW) & F.lower(text).contains("claim")


def cashtag(text: Column, mode: str = "literal") -> Column:
    """True for ticker symbols such as ``$BTC``.

    ``literal``, the default, reads the rule as a whole-text pattern in which the percent signs
    stand for themselves, so it hardly ever fires. ``intent`` looks for the symbol anywhere.
    """
    patterns = {"intent": CASHTAG, "literal": CASHTAG_WHOLE_TEXT}
    return text.rlike(patterns[mode])


def loose_spam(text: Column, whole_words: bool = False) -> Column:
    return mentions_any(text, LOOSE_SPAM, whole_words)


def strict_spam(text: Column, cashtag_mode: str = "literal", whole_words: bool = False) -> Column:
    """Every strict rule together. The four word lists and the greetings run as one regex pass."""
    words = [w for group in SPAM_LISTS.values() for w in group]
    one_pass = (
        r"\A(?:" + "|".join(LOW_EFFORT_PREFIXES) + ")|" + _any_word(words, whole_words)
    )
    return F.lower(text).rlike(one_pass) | short_claim(text) | cashtag(text, cashtag_mode)


def spam_flags(text: Column, cashtag_mode: str = "literal") -> dict[str, Column]:
    """Each rule on its own, for reports on what the rules drop."""
    flags = {
        "loose_spam": loose_spam(text),
        "low_effort": low_effort(text),
        "short_claim": short_claim(text),
        "cashtag": cashtag(text, cashtag_mode),
    }
    for name, words in SPAM_LISTS.items():
        flags[name] = mentions_any(text, words)
    flags["strict_spam"] = strict_spam(text, cashtag_mode)
    return flags


def url_only(text: Column, embeds: Column) -> Column:
    return (text == "") & embeds.isNotNull() & (embeds != "")
