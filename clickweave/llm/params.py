"""Production parameters of the registered queries."""

from __future__ import annotations

from clickweave.llm.link_trust import Rule

# op7: target share of each source; all others and null share OTHER_SHARE.
TARGETS = {"src0": 0.10} | {f"src{i}": 0.88 / 19 for i in range(1, 20)}
OTHER_SHARE = 0.02

# op9: fixed values, the contract's rules.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
