"""Fields of scanned association certificates: a text's lines are typed one by one, then read section by section."""

from __future__ import annotations

import string
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The sections read, the words of their printed labels, and those that tell a label from other text.
SECTIONS = (5, 6, 7, 8)
LABEL_WORDS = {
    5: "name and mailing address of the association",
    6: "name mailing address phone number & and e-mail email for the designated representative",
    7: "website address where all dedicatory instruments can be found",
    8: "other information signature",
}
TELLING = {5: [{"name", "mailing", "address", "association"}], 6: [{"designated", "representative"}], 7: [{"website", "address"}, {"dedicatory", "instruments"}], 8: []}
ADDRESS_STARTS = ("c/o", "attn")
DOMAIN_ENDS = ("com", "org", "net", "io", "us", "gov", "info", "biz")
MAX_CHARS = 4000
# What each finding adds to the confidence.
WEIGHTS = {"numbered": 0.35, "label": 0.20, "phone": 0.10, "email": 0.10, "website": 0.05, "assoc": 0.05, "order": -0.15}

TEXTS = ["assoc_mailing_address", "hoa_name", "hoa_mailing_address", "mgmt_name", "mgmt_mailing_address", "mgmt_phone", "mgmt_phone_normalized", "mgmt_email", "website", "field_6_raw", "enrich_status", "review_reasons"]
RESULT = T.StructType([*[T.StructField(n, T.StringType()) for n in TEXTS], T.StructField("confidence", T.DoubleType()), T.StructField("needs_review", T.BooleanType())])


@dataclass
class Section:
    number: int
    numbered: bool
    lines: list[str] = field(default_factory=list)


def _bare(word: str) -> str:
    return word.strip(string.punctuation.replace("&", "")).lower()


def _number_of(line: str) -> int | None:
    """Section that a line opens by its number, as in '6.', '7)' or '5 :'."""
    t = line.lstrip()
    return int(t[0]) if t[:1] in {str(n) for n in SECTIONS} and t[1:].lstrip()[:1] in set(".):,") else None


def _label_of(line: str) -> int | None:
    """Section whose printed label a line holds."""
    words = {_bare(w) for w in line.split()}
    return next((n for n in SECTIONS if any(told <= words for told in TELLING[n])), None)


def _after_label(n: int, line: str) -> str:
    """The line after its printed label: the first run of three words of the label or more, which a colon ends."""
    vocabulary, words = {_bare(w) for w in LABEL_WORDS[n].split()}, line.split()
    run = 0
    for i, w in enumerate([*words, ""]):
        if run and i and (words[i - 1].endswith(":") or _bare(w) not in vocabulary or not w):
            if run >= 3:
                return " ".join(words[i:])
            run = 0
        run += _bare(w) in vocabulary
    return line


def scan(text: str) -> list[Section]:
    """Sections in the order of the text. Numbers open them; a label does so for a section that no number opens."""
    lines = text.splitlines()
    numbers = [_number_of(x) for x in lines]
    wanted = set(SECTIONS) - {n for n in numbers if n}
    out: list[Section] = []
    seen: set[int] = set()
    for line, n in zip(lines, numbers):
        if n and n not in seen:
            rest = line.lstrip()[1:].lstrip()[1:].strip()
            out.append(Section(n, True, [_after_label(n, rest)]))
        elif (n := _label_of(line)) in wanted - seen:
            out.append(Section(n, False, [_after_label(n, line)]))
        elif out:
            # a label may run on to the line below its number
            out[-1].lines.append(_after_label(out[-1].number, line) if not any(x.strip() for x in out[-1].lines) else line)
            continue
        else:
            continue
        seen.add(n)
    return out


# --- typed parts of a line --------------------------------------------------------------------------------------------

def find_phone(text: str) -> str | None:
    """The first stretch of digits and phone punctuation with ten digits, or eleven after a 1."""
    at = 0
    while at < len(text):
        if text[at] not in "0123456789(+":
            at += 1
            continue
        end = at
        while end < len(text) and text[end] in "0123456789()+-. \t":
            end += 1
        for start in range(at, end):
            if text[start] in "0123456789(+" and (start == 0 or not text[start - 1].isdigit()):
                # as far as ten digits reach, or eleven if the first is a 1
                digits, stop, gap = "", start, 0
                need = 10
                while stop < end and len(digits) < need and gap <= 3:
                    gap = 0 if text[stop].isdigit() else gap + 1
                    if text[stop].isdigit():
                        digits += text[stop]
                        need = 11 if digits[0] == "1" else 10
                    stop += 1
                if len(digits) == need and not text[stop : stop + 1].isdigit():
                    return text[start:stop].strip()
        at = end
    return None


def _pieces(text: str) -> list[str]:
    """Blank-separated pieces without brackets and end punctuation."""
    return [p for w in text.replace("<", " ").replace(">", " ").split() if (p := w.strip("()[]{}\"',;:.!?"))]


def find_email(text: str) -> str | None:
    for p in _pieces(text):
        name, at, host = p.partition("@")
        if at and name and "." in host.strip(".") and "@" not in host and host.rsplit(".", 1)[1].isalpha():
            return p.removeprefix("mailto:")
    return None


def find_links(text: str) -> list[str]:
    """Web addresses, or else bare domains, in order."""
    pieces = [p for p in _pieces(text) if "@" not in p]
    full = [p for p in pieces if p.lower().startswith(("http://", "https://"))]
    return full or [p for p in pieces if "." in p and p.split("/")[0].lower().rsplit(".", 1)[-1] in DOMAIN_ENDS]


def _is_address(part: str) -> bool:
    """Does a part start or belong to a postal address: a house number, a box, a zip, a state, care-of?"""
    words = part.replace(",", " ").split()
    if not words:
        return False
    box = "".join(c for c in part.lower() if c.isalpha()).find("pobox") >= 0
    zipped = any(len(w.split("-")[0]) == 5 and w.replace("-", "").isdigit() for w in words)
    state = len(words[-1]) == 2 and words[-1].isalpha() and words[-1].isupper() and (len(words) == 1 or "," in part)
    return box or zipped or state or (words[0].isdigit() and len(words) > 1) or words[0].lower().strip(":") in ADDRESS_STARTS


def _joined(parts: list[str]) -> str | None:
    return ", ".join(p for x in parts if (p := " ".join(x.split()).strip(" ,;"))) or None


def name_and_address(block: str | None) -> tuple[str | None, str | None]:
    """A block split where the first part looks like an address; lines are parts, commas are if there is one line."""
    parts = [x for x in (block or "").splitlines() if x.strip(" ,;")]
    if len(parts) == 1:
        parts = [x for x in parts[0].split(",") if x.strip(" ,;")]
    at = next((i for i, p in enumerate(parts) if _is_address(p.strip(" ,;"))), len(parts))
    return _joined(parts[:at]), _joined(parts[at:])


def _manager(lines: list[str]) -> dict:
    """Name, address, phone and e-mail of the representative's section; what is typed is taken out before the name is read."""
    rest = "\n".join(lines)
    email, phone = find_email(rest), find_phone(rest)
    for found in (email, phone):
        rest = rest.replace(found, " ", 1) if found else rest
    kept = [x for x in rest.splitlines() if _bare(x) not in ("phone", "tel", "telephone", "e-mail", "email")]
    name, address = name_and_address("\n".join(kept))
    return {"mgmt_email": email, "mgmt_phone": phone, "mgmt_phone_normalized": "".join(c for c in phone if c.isdigit()) if phone else None, "mgmt_name": name, "mgmt_mailing_address": address, "field_6_raw": "\n".join(" ".join(x.split()) for x in lines).strip() or None}


def parse_certificate(text: str | None) -> dict:
    """All fields of a certificate; enrich_status is ok if section 5 or 6 is there, review_reasons name what is odd or missing."""
    out: dict = dict.fromkeys(TEXTS) | {"confidence": 0.0, "needs_review": True, "enrich_status": "not_found"}
    if not (text or "").strip():
        return out | {"review_reasons": "empty_ocr"}
    found = {s.number: s for s in scan(text)}
    order = list(found)
    reasons = []
    for n in (5, 6):
        if n not in found or not found[n].numbered:
            reasons.append(f"missing_field_{n}_anchor")
            reasons += [f"field_{n}_label_fallback"] if n in found else []
    if disordered := order != sorted(order):
        reasons.append("anchor_order")
    if 5 in found:
        out["assoc_mailing_address"] = _joined(found[5].lines)
        out["hoa_name"], out["hoa_mailing_address"] = name_and_address("\n".join(found[5].lines))
    if 6 in found:
        out |= _manager(found[6].lines)
    if 7 in found:
        out["website"] = " | ".join(dict.fromkeys(find_links("\n".join(found[7].lines)))) or None
    for n in TEXTS:
        if out[n] and len(out[n]) > MAX_CHARS:
            out[n] = out[n][:MAX_CHARS]
            reasons.append("value_truncated")
    if 6 in found:
        reasons += [f"missing_{x}" for x in ("phone", "email") if not out[f"mgmt_{x}"]]
    parts = ["numbered" if found[n].numbered else "label" for n in (5, 6) if n in found]
    parts += [k for k, v in {"phone": out["mgmt_phone"], "email": out["mgmt_email"], "website": out["website"], "assoc": out["assoc_mailing_address"], "order": disordered}.items() if v]
    score = min(1.0, max(0.0, sum(WEIGHTS[p] for p in parts)))
    return out | {"confidence": round(score, 2), "needs_review": bool(reasons), "review_reasons": ";".join(dict.fromkeys(reasons)) or None, "enrich_status": "ok" if {5, 6} & set(found) else "not_found"}


@F.pandas_udf(RESULT)
def certificate_fields(text: pd.Series) -> pd.DataFrame:
    """Struct of all fields of a certificate's text; status not_found for NULL and blank ones."""
    return pd.DataFrame([parse_certificate(t) for t in text], columns=[f.name for f in RESULT.fields])
