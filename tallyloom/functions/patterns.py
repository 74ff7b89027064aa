"""Patterns, word lists and constants that results depend on, in the order in which they apply."""

from __future__ import annotations

# Fixed values. A message holds a secret or personal data if one of these is found in it.
SECRETS = (
    r"sk-[a-zA-Z0-9_]{8,}",
    r"gsk_[a-zA-Z0-9]{8,}",
    r"ntn_[a-zA-Z0-9]{8,}",
    r"ghp_[a-zA-Z0-9]{8,}",
    r"xoxb-[a-zA-Z0-9-]+",
    r"(?i)key[_-]?[a-zA-Z0-9]{16,}",
    r"(?s)-----BEGIN .* KEY-----",
    r"(?i)password\s*[=:]\s*\S+",
    r"(?i)token\s*[=:]\s*[\"']?\S{10,}",
    r"(?i)export\s+\w*(?:KEY|TOKEN|SECRET|PASSWORD)\w*\s*=",
    r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    r"[a-zA-Z0-9._%+-]{1,64}@[a-zA-Z0-9.-]{1,253}\.[a-zA-Z]{2,10}",
    r"\.env\b",
    r"(?i)credentials?\.(json|yaml|yml|toml)",
)

# Fixed values. A message follows up on an earlier one if one of these is found in it.
FOLLOW_UPS = (
    r"(?i)^(now|also|then|and|next|what about|how about)\b",
    r"(?i)^(compare that|expand on|tell me more|go deeper|elaborate)",
    r"(?i)\b(the previous|from before|you just said|your answer|that result)\b",
)

# Fixed values. Each phrase found lowers a response's confidence, by 20 and by 30.
HEDGES = ("i'm not sure", "i think", "probably", "might be", "could be", "unclear", "ambiguous", "it depends", "hard to say", "i believe", "perhaps", "possibly", "not certain")
REFUSALS = ("i can't", "i cannot", "i don't have enough", "beyond my capability", "i'm unable to", "not able to", "outside my", "i need more context")

# Fixed values. Contamination categories and their patterns.
CONTAMINATION = {
    "html_comment_injection": (
        r"(?is)<!--\s*(?:(?:ignore|disregard|forget|override|replace)\b|system\s*(?:prompt|message|instruction)|admin\s*(?:command|override|instruction)|(?:new|updated?|real)\s*(?:instructions?|rules?|prompt)|you\s+are\s+now|(?:act|behave|respond)\s+as|do\s+not\s+(?:follow|obey|listen)|(?:inject|execute|eval)).*?-->",
    ),
    "invisible_text": (
        r"[\x{200b}\x{200c}\x{200d}\x{200e}\x{200f}\x{feff}\x{2060}\x{2061}\x{2062}\x{2063}\x{2064}]{5,}",
        r"(?is)<\s*(?:span|div|p)\s+[^>]*(?:display\s*:\s*none|visibility\s*:\s*hidden|font-size\s*:\s*0)[^>]*>.*?</\s*(?:span|div|p)\s*>",
        r"(?is)<\s*(?:span|div|p)\s+[^>]*color\s*:\s*(?:white|#fff(?:fff)?|rgb\s*\(\s*255)[^>]*>.*?</\s*(?:span|div|p)\s*>",
    ),
    "prompt_injection": (
        r"(?i)ignore\s+(?:all\s+)?(?:previous|prior|above|earlier)\s+(?:instructions?|rules?|guidelines?|context)",
        r"(?i)disregard\s+(?:all\s+)?(?:previous|prior|above|earlier)\s+(?:instructions?|rules?|guidelines?|context)",
        r"(?i)forget\s+(?:everything|all|your)\s+(?:instructions?|rules?|guidelines?|training)",
        r"(?i)(?:new|updated?|real|actual)\s+system\s+(?:instructions?|rules?|prompt|role)",
        r"(?i)you\s+are\s+now\s+(?:a|an|the)\s+\w+",
        r"(?i)(?:act|behave|respond|pretend)\s+as\s+if\s+you\s+(?:are|were)\b",
        r"(?i)(?:system|admin|root)\s*(?:prompt|override|command|instruction)\s*:",
        r"(?i)</?\s*(?:system|admin|root)\s*(?:prompt|message|instruction)\s*/?>",
        r"(?i)\[SYSTEM\]|\[ADMIN\]|\[OVERRIDE\]|\[INSTRUCTION\]",
        r"(?i)\[/?INST\]",
        r"(?is)<<\s*SYS\s*>>.*?<<\s*/SYS\s*>>",
        r"(?i)\[/?INST\]\s*(?:ignore|disregard|forget|override)",
    ),
    "command_injection": (
        r"(?i)(?:^|\s)(?:rm\s+-rf|sudo\s+rm|chmod\s+777|mkfs)",
        r"(?i)(?:curl|wget)\s+[^\s]+\s*\|\s*(?:sh|bash|zsh|python)",
        r"(?i)(?:^|\s)(?:eval|exec)\s*\([\"']",
        r"(?i)__import__\s*\(\s*[\"']os[\"']",
        r"(?i)os\.(?:system|popen|exec[lv]?p?e?)\s*\(",
        r"(?i)subprocess\.(?:call|run|Popen|check_output)\s*\(",
        r"(?i)base64\s+(?:-d|--decode)\s*.*\|\s*(?:sh|bash)",
    ),
    "structure_attack": (
        r"(?is)<\s*script\b[^>]*>.*?</\s*script\s*>",
        r"(?i)<\s*script\b[^>]*/\s*>",
        r"(?i)<\s*/?(?:system[-_]?(?:prompt|message|instruction)|admin[-_]?(?:override|command)|assistant[-_]?(?:instruction|override))\s*/?>",
        r"(?i)```\s*(?:system|admin|override|instruction)\b",
        r"(?im)^#{1,3}\s+(?:System\s+(?:Prompt|Instructions?|Override)|Admin\s+(?:Commands?|Override)|New\s+Instructions?)\s*$",
    ),
    "exfiltration": (
        r"(?i)(?:send|post|upload|exfiltrate|transmit)\s+(?:to|data|file|content)\s+(?:to\s+)?(?:https?://|ftp://)",
        r"(?i)(?:webhook|callback|endpoint)\s*[=:]\s*(?:https?://|ftp://)",
    ),
    "filler_text": (
        r"(?i)(?:We use cookies|This (?:site|website) uses cookies|By (?:continuing|using) (?:this|our) (?:site|website)|Accept (?:all )?cookies|Cookie (?:policy|preferences|settings|consent))[\s\S]{0,300}?(?:Accept|Decline|Settings|Preferences|Got it|OK|Close)\b",
        r"(?i)(?:Subscribe to (?:our|the) (?:newsletter|mailing list|updates)|Sign up for (?:our|the|free) (?:newsletter|updates|weekly)|Enter your email|Get (?:our|the) (?:latest|weekly|daily)|Join \d[\d,]* (?:subscribers|readers|people))[\s\S]{0,200}?(?:Subscribe|Sign up|Join|Submit|Get)",
        r"(?i)(?:Share (?:this|on)|Follow us on|Connect with us)\s*(?:(?:Facebook|Twitter|LinkedIn|Instagram|Pinterest|YouTube|TikTok|X\.com)\s*[,|/\s]*){2,}",
        r"(?m)^(?:Home\s*[>→/]\s*){1}(?:\w+\s*[>→/]\s*)+\w+\s*$",
        r"(?i)(?:^|\n)(?:Related (?:Posts?|Articles?|Stories|Reading)|You (?:May|Might) Also (?:Like|Enjoy)|More (?:from|on) (?:this|our))\s*\n(?:[-•*]\s+\[?[^\n]+\n){2,}",
    ),
}
# Literals, in lower case, of which every match of a category's patterns holds at least one; they spare most texts the patterns.
CONTAMINATION_NEEDS = {
    "html_comment_injection": (("<!--",),),
    "invisible_text": ((), ("display", "visibility", "font-size"), ("color",)),
    "prompt_injection": (("ignore",), ("disregard",), ("forget",), ("system",), ("now",), ("if",), ("prompt", "override", "command", "instruction"), ("system", "admin", "root"), ("[system]", "[admin]", "[override]", "[instruction]"), ("inst]",), ("<<",), ("inst]",)),
    "command_injection": (("-rf", "sudo", "chmod", "mkfs"), ("curl", "wget"), ("eval", "exec"), ("__import__",), ("os.",), ("subprocess",), ("base64",)),
    "structure_attack": (("script",), ("script",), ("system", "admin", "assistant"), ("```",), ("system", "admin", "instruction")),
    "exfiltration": (("://",), ("://",)),
    "filler_text": (("cookie", "by continuing", "by using"), ("subscribe", "sign up", "enter your email", "get our", "get the", "join "), ("share ", "follow us", "connect with"), ("home",), ("related ", "also ", "more ")),
}
#: From so many categories on, a text is blocked.
BLOCK_CATEGORIES = 3

# Fixed values. Lines of a page's frame, which trimming removes.
NAVIGATION = (
    r"(?i)^\s*\[?(Home|About|Contact|Menu|Navigation|Search|Subscribe|Login|Sign [Uu]p|Register)\]?\s*$",
    r"(?i)^\s*\[?(Previous|Next|Prev|Back|Forward|Read [Mm]ore|Continue [Rr]eading|Show [Mm]ore)\]?\s*$",
    r"(?i)^\s*\[?(Skip to .*|Jump to .*|Go to .*)\]?\s*$",
    r"(?i)^\s*(Share|Tweet|Pin|Email|Print|Copy [Ll]ink|SHARE:?)\s*$",
    r"(?i)^\s*\[?(Facebook|Twitter|LinkedIn|Instagram|YouTube|TikTok|Pinterest|Reddit|WhatsApp)\]?\s*$",
)
# Fixed values. Such a line goes, and all after it up to a blank one.
BLOCK_STARTS = (
    r"(?i)^\s*#{1,3}\s*(Related (?:Articles?|Posts?|Stories?|Content)|You (?:May|Might) Also (?:Like|Enjoy)|More (?:From|Like This|Stories)|Recommended|Popular (?:Posts?|Articles?)|Trending|Also (?:Read|See)|Further Reading)",
    r"(?i)^\s*\*{0,2}(Related (?:Articles?|Posts?)|You (?:May|Might) Also)",
    r"(?i)^\s*#{1,3}\s*(Comments?|Leave a (?:Reply|Comment)|Discussion|Responses?)\s*$",
    r"(?i)^\s*#{1,3}\s*(Newsletter|Subscribe|Get (?:Our|The) Newsletter|Sign [Uu]p|Join (?:Our|The))\s*$",
    r"(?i)^\s*#{1,3}\s*(About [Tt]he [Aa]uthor|Author [Bb]io|Written [Bb]y)\s*$",
    r"(?i)^\s*#{1,3}\s*(Tags?|Categories?|Topics?|Filed [Uu]nder)\s*$",
    r"(?i)^\s*#{1,3}\s*(Footer|Copyright|All [Rr]ights [Rr]eserved)\s*$",
)
# Fixed values. Single lines that go.
SINGLE_LINES = (
    r"^\s*!\[.*?\]\(.*?\)\s*$",
    r"^\s*\[!\[.*?\]\(.*?\)\]\(.*?\)\s*$",
    r"(?i)^\s*<img\b[^>]*/?>\s*$",
    r"(?i)^\s*<iframe\b[^>]*>.*?</iframe>\s*$",
    r"(?i)^\s*Cookie",
    r"(?i)^\s*We use cookies",
    r"(?i)^\s*This (?:website|site) uses cookies",
    r"(?i)^\s*Accept (?:All )?Cookies?\s*$",
    r"(?i)^\s*\d+ comments?\s*$",
    r"(?i)^\s*Loading\.{0,3}\s*$",
    r"(?i)^\s*Advertisement\s*$",
    r"(?i)^\s*Sponsored\s*$",
    r"(?i)^\s*Photo:?\s*$",
    r"(?i)^\s*Image:?\s*$",
    r"(?i)^\s*Credit:?\s*$",
    r"(?i)^\s*\| \|",
    r"^\s*\[\s*\]\s*$",
    r"^\s*\*\s*\*\s*\*\s*$",
    r"^\s*---+\s*$",
    r"^\s*\x{200c}+\s*$",
)

# Fixed values of the energy estimate: Wh for a call by class, overhead of the building, g CO2e for a kWh.
WATT_HOURS = {"large": 2.0, "medium": 0.8, "small": 0.2}
WATT_HOURS_OTHER = 0.9
# Words in a model's id that tell its class.
MODEL_CLASSES = {"large": ("large", "opus"), "medium": ("medium", "sonnet"), "small": ("small", "haiku")}
OVERHEAD = 1.135
GRAMS_PER_KWH = 379.0
# G CO2e of a search, a telephone charge, a mile driven, an hour of video, a cup of coffee.
EQUIVALENTS = {"searches": 0.2, "charges": 12.4, "miles": 393.0, "video_hours": 36.0, "cups": 21.0}

# Prices for a token by model; writing to a cache costs 1.25 times, reading from it 0.1 times the input price.
PRICES = {
    "large-1": (15.00 / 1_000_000, 75.00 / 1_000_000),
    "medium-1": (3.00 / 1_000_000, 15.00 / 1_000_000),
    "small-1": (0.80 / 1_000_000, 4.00 / 1_000_000),
}
DEFAULT_MODEL = "medium-1"
CACHE_WRITE, CACHE_READ = 1.25, 0.10

# Fixed values of rule scoring and of the state that decays.
EXPLICIT, UNIVERSAL, TOOL = 0.4, 0.3, 0.2
THRESHOLD, BUDGET, INJECTED = 0.5, 5, 3
SPIKE_CAP, IMMUNE_SPIKE, DECAY_PER_DAY = 0.15, 0.20, 0.010
SPREAD = 0.2
INACTIVE_DAYS, COOLDOWN_DAYS, MOST_DAYS = 60, 30, 365
MERGE_RATIO, MERGE_LEAST = 0.90, 10
MOST_PAIRS, LEAST_EITHER = 500, 5
SPIKES = {"hook": 0.15, "self_check": 0.08, "user": 0.15, "audit": 0.06, "graduation": 0.10}
OTHER_SPIKE = 0.08

# Fixed values of source weights.
COMPRESSION, BLEND, FLOOR, CEILING = 0.45, 0.5, 0.70, 1.80
BOOST_PER_HIT, BOOST_CAP = 2.0, 6.0
