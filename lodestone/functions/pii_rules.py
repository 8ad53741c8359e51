"""PII rule tables: built-in rules, Indian identifiers, labelled fields."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column

from lodestone.functions.checks import aadhaar_valid, luhn_valid, pan_valid


@dataclass(frozen=True)
class Rule:
    """A pattern with its category; `check` must hold for a match, `group` is the span's capture group."""

    name: str
    category: str
    pattern: str
    ignore_case: bool = True
    check: str | None = None
    group: int = 0

    @property
    def needs(self) -> tuple[str, ...]:
        """What a text must hold for the pattern to be worth a scan: single characters, or a plain pattern."""
        return NEEDS.get(self.name, ()) if self in SHIPPED else ()

    @property
    def java(self) -> str:
        # (?u) and (?U): letters, digits and word boundaries as in Unicode
        return ("(?iuU)" if self.ignore_case else "(?U)") + self.pattern


CHECKS = {"luhn": luhn_valid, "aadhaar": aadhaar_valid, "pan": pan_valid}

# fixed values: the built-in rules, in order (order breaks ties between equal spans)
BUILTIN: tuple[Rule, ...] = (
    Rule("email", "EMAIL", r"\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"),
    Rule("phone_e164", "PHONE", r"(?<!\d)\+\d{1,3}[\s\-.]?(?:\(?\d{1,4}\)?[\s\-.]?){1,4}\d{2,4}(?!\d)"),
    Rule("phone_in", "PHONE", r"(?<!\d)(?:0|91)?[\s\-]?[6-9]\d{9}(?!\d)"),
    Rule("credit_card", "CREDIT_CARD", r"(?<!\d)(?:\d[ \-]?){13,19}\d(?!\d)", check="luhn"),
    Rule("iban", "IBAN", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b"),
    Rule("ipv4", "IP_ADDRESS", r"(?<!\d\.)(?:(?:25[0-5]|2[0-4]\d|1?\d{1,2})\.){3}(?:25[0-5]|2[0-4]\d|1?\d{1,2})(?!\.\d)"),
    Rule("ipv6", "IP_ADDRESS", r"\b(?:[A-F0-9]{1,4}:){2,7}[A-F0-9]{1,4}\b"),
    Rule("url_credential", "CREDENTIAL", r"https?://[^/\s:@]+:[^/\s:@]+@[^\s]+"),
    Rule("gps_coords", "LOCATION", r"(?<!\d)-?(?:90|[1-8]?\d(?:\.\d{3,8}))\s*,\s*-?(?:180|1[0-7]\d|\d{1,2})(?:\.\d{3,8})(?!\d)"),
    Rule("aadhaar", "GOV_ID_IN", r"(?<!\d)\d{4}[\s\-]?\d{4}[\s\-]?\d{4}(?!\d)"),
    Rule("pan", "GOV_ID_IN", r"\b[A-Z]{5}\d{4}[A-Z]\b"),
    Rule("gstin", "GOV_ID_IN", r"\b\d{2}[A-Z]{5}\d{4}[A-Z][1-9A-Z]Z[0-9A-Z]\b"),
    Rule("aws_access_key", "CREDENTIAL", r"\b(?:AKIA|ASIA|AGPA)[0-9A-Z]{16}\b", ignore_case=False),
    Rule("generic_secret", "CREDENTIAL", r"\b(?:sk|api|key|token|bearer)[-_][A-Za-z0-9_\-]{16,}\b"),
    Rule("ssn_us", "GOV_ID_US", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
)

# fixed values: Indian identifiers
INDIAN_IDS: tuple[Rule, ...] = (
    Rule("aadhaar_verhoeff", "GOV_ID_IN", r"(?<!\d)\d{4}[\s\-]?\d{4}[\s\-]?\d{4}(?!\d)", check="aadhaar"),
    Rule("pan_with_checksum", "GOV_ID_IN", r"\b[A-Z]{5}\d{4}[A-Z]\b", check="pan"),
    Rule("indian_mobile", "PHONE", r"(?<!\d)(?:\+91[\s\-]?|0)?[6-9]\d{9}(?!\d)"),
    Rule("voter_id_epic", "GOV_ID_IN", r"\b[A-Z]{3}\d{7}\b"),
    Rule("driving_license_in", "GOV_ID_IN", r"\b[A-Z]{2}[\s\-]?\d{2}[\s\-]?(?:19|20)\d{2}[\s\-]?\d{7}\b"),
)

# fixed values: four rules bounded as in RE2, the engine of the catalogue's SQL: \b knows ASCII only, \s no vertical tab, and there is no
# lookaround. (?i) has two more letters there that fold to s and k.
_WORD = "[0-9A-Za-z_]"
_B = f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"
_AZ = r"A-Za-z\u017F\u212A"
_BLANK = r"[\t\n\f\r \-.]"
PLAIN: tuple[Rule, ...] = (
    Rule("email", "EMAIL", rf"{_B}[{_AZ}0-9._%+\-]+@[{_AZ}0-9.\-]+\.[{_AZ}]{{2,}}{_B}", ignore_case=False),
    Rule("phone_e164", "PHONE", rf"\+[0-9]{{1,3}}{_BLANK}?(?:\(?[0-9]{{1,4}}\)?{_BLANK}?){{1,4}}[0-9]{{2,4}}", ignore_case=False),
    Rule("credit_card", "CREDIT_CARD", rf"{_B}(?:[0-9][ \-]?){{13,19}}[0-9]{_B}", ignore_case=False, check="luhn"),
    Rule("ipv4", "IP_ADDRESS", r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})", ignore_case=False),
)

# every match of the rule holds these
DIGIT = r"\p{Nd}"
NEEDS: dict[str, tuple[str, ...]] = {
    "email": ("@", "."),
    "phone_e164": ("+",),
    "phone_in": (DIGIT,),
    "credit_card": (DIGIT,),
    "iban": (DIGIT,),
    "ipv4": (".", DIGIT),
    "ipv6": (":",),
    "url_credential": ("@", ":"),
    "gps_coords": (",", ".", DIGIT),
    "aadhaar": (DIGIT,),
    "pan": (DIGIT,),
    "gstin": (DIGIT,),
    "aws_access_key": ("A", "(?:AKIA|ASIA|AGPA)"),
    "generic_secret": ("[-_]",),
    "ssn_us": ("-", DIGIT),
    "aadhaar_verhoeff": (DIGIT,),
    "pan_with_checksum": (DIGIT,),
    "indian_mobile": (DIGIT,),
    "voter_id_epic": (DIGIT,),
    "driving_license_in": (DIGIT,),
}
SHIPPED = frozenset((*BUILTIN, *INDIAN_IDS, *PLAIN))

# fixed values: field labels by group, with category and longest value
FIELD_GROUPS: tuple[tuple[str, str, int, tuple[str, ...]], ...] = (
    ("field_name", "PERSON", 80, (r"name", r"full\s+name", r"farmer\s+name", r"applicant", r"नाम", r"पूरा\s+नाम", r"નામ", r"নাম", r"ਨਾਮ", r"ಹೆಸರು", r"പേര്", r"పేరు", r"பெயர்")),
    ("field_phone", "PHONE", 80, (r"mobile", r"phone", r"contact(?:\s+(?:no\.?|number))?", r"मोबाइल", r"फ़ोन", r"फोन", r"মোবাইল", r"মোবাইল\s+ন", r"ਫੋਨ", r"ஃபோன்", r"ఫోన్", r"ಫೋನ್")),
    ("field_aadhaar", "GOV_ID_IN", 32, (r"aadhaar", r"aadhar", r"uid", r"आधार", r"ਆਧਾਰ", r"আধার", r"ஆதார்", r"ఆధార్", r"ಆಧಾರ್")),
    ("field_pan", "GOV_ID_IN", 16, (r"pan", r"पैन", r"ਪੈਨ", r"প্যান", r"పాన్")),
    ("field_voter", "GOV_ID_IN", 24, (r"voter\s*id", r"epic", r"वोटर")),
    ("field_dl", "GOV_ID_IN", 32, (r"driving\s+licen[cs]e", r"dl\s+no", r"ड्राइविंग")),
    ("field_dob", "DATE_TIME", 24, (r"dob", r"date\s+of\s+birth", r"birth\s+date", r"जन्म\s+तिथि", r"जन्म\s+ता", r"ജനന\s+തീയതി", r"பிறந்த\s+தேதி")),
    ("field_address", "LOCATION", 80, (r"address", r"village", r"पता", r"गाँव", r"গ্রাম", r"ગામ", r"ஊர்")),
)
FIELDS: tuple[Rule, ...] = tuple(
    Rule(name, category, rf"((?:{'|'.join(labels)})\s*[:\-=]\s*)([^\r\n,;]{{1,{longest}}})", group=2) for name, category, longest, labels in FIELD_GROUPS
)

# fixed values: Indic blocks and the language that each stands for
SCRIPTS = (
    (0x0900, 0x097F, "hi"),
    (0x0980, 0x09FF, "bn"),
    (0x0A00, 0x0A7F, "pa"),
    (0x0A80, 0x0AFF, "gu"),
    (0x0B00, 0x0B7F, "or"),
    (0x0B80, 0x0BFF, "ta"),
    (0x0C00, 0x0C7F, "te"),
    (0x0C80, 0x0CFF, "kn"),
    (0x0D00, 0x0D7F, "ml"),
)


def check_of(rule: Rule, match: Column) -> Column | None:
    return CHECKS[rule.check](match) if rule.check else None


def load_rules(config: dict) -> tuple[Rule, ...]:
    """Rules from a parsed config: {include_builtins: bool, rules: [{name, category, pattern, flags?, luhn_check?}]}.

    A rule without flags ignores case; a rule named like a built-in one replaces it.
    """
    own = []
    for r in config.get("rules") or []:
        flags = r.get("flags")
        fold = True if flags is None else any("IGNORECASE" in str(f).upper() for f in (flags if isinstance(flags, list) else [flags]))
        own.append(Rule(r["name"], r["category"], r["pattern"], fold, "luhn" if r.get("luhn_check") else None))
    if not config.get("include_builtins", True):
        return tuple(own)
    named = {r.name: r for r in own}
    kept = [named.pop(b.name, b) for b in BUILTIN]
    return (*kept, *named.values())


def rules_to_dict(rules: tuple[Rule, ...]) -> list[dict]:
    return [{"name": r.name, "category": r.category, "pattern": r.pattern, "flags": ["IGNORECASE"] if r.ignore_case else [], "luhn_check": r.check == "luhn"} for r in rules]


def without(rules: tuple[Rule, ...], *categories: str) -> tuple[Rule, ...]:
    return tuple(replace(r) for r in rules if r.category not in categories)
