"""HTML -> main text with Spark string functions; rules are our own.

Comments, scripts, styles, navigation, footers, forms, advertisement and reader
comment blocks go; tables stay, one line per row; block elements end a line;
entities are decoded last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight.functions.text import strip

DROPPED_ELEMENTS = (
    "head", "script", "style", "noscript", "template", "nav", "footer", "aside", "form",
    "iframe", "svg", "button", "select",
)
DROPPED_CLASSES = "ad|ads|advert|advertisement|comment|comments|sidebar|breadcrumbs?|cookie"
BLOCK_ELEMENTS = (
    "address|article|blockquote|body|br|caption|dd|div|dl|dt|figcaption|figure|h[1-6]|header|hr|"
    "html|li|main|ol|p|pre|section|table|tbody|tfoot|thead|title|tr|ul"
)
# named entities; &amp; must stay last so that nothing is decoded twice
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®",
    "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘",
    "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€",
    "agrave": "à", "acirc": "â", "ccedil": "ç", "egrave": "è", "eacute": "é", "ecirc": "ê",
    "icirc": "î", "ocirc": "ô", "ugrave": "ù", "ucirc": "û", "amp": "&",
}


def _numeric_entities(text: Column) -> Column:
    """Decode ``&#233;`` and ``&#xe9;`` through their UTF-32 bytes."""

    def decode(part: Column, index: Column) -> Column:
        digits = F.regexp_extract(part, r"^(\d{1,7});", 1)
        hexes = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(digits != "", digits.try_cast("int")).otherwise(
            F.conv(F.when(hexes != "", hexes), 16, 10).try_cast("int")
        )
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.substring(part, F.instr(part, ";") + 1, F.length(part))
        return (
            F.when(index == 0, part)
            .when(valid, F.concat(char, rest))
            .otherwise(F.concat(F.lit("&#"), part))
        )

    return F.array_join(F.transform(F.split(text, "&#"), decode), "")


def page_text(html: Column) -> Column:
    """Main text of a page, lines separated by one line break."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    dropped = "|".join(DROPPED_ELEMENTS)
    text = F.regexp_replace(text, rf"(?is)<({dropped})\b[^>]*>.*?</\1\s*>", "\n")
    text = F.regexp_replace(
        text, rf'(?is)<div\b[^>]*(?:class|id)="(?:{DROPPED_CLASSES})"[^>]*>.*?</div\s*>', "\n"
    )
    text = F.regexp_replace(text, r"(?i)</t[dh]\s*>", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCK_ELEMENTS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?s)<[a-zA-Z/!?][^>]*>", "")
    text = _numeric_entities(text)
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    text = F.regexp_replace(text, r"[ \t\r\x0b\f\xa0]+", " ")
    return strip(F.regexp_replace(text, r" ?\n[ \n]*", "\n"))
