"""The prompt around a digest's text. A caller may pass any other template."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Own wording; the keys and their domains are fixed values of the document schema.
DEFAULT_TEMPLATE = """List every enforcement action reported in the digest below.

Digest:
{content}

Answer with one JSON object and nothing else:
{"actions": [{"action_type": "administrative|civil|criminal", "title": null,
 "respondents": [{"name": "", "entity_type": "individual|company|other", "location": null}],
 "violations": [{"statute": null, "description": null}],
 "sanctions": [{"sanction_type": "suspension|revocation|injunction|fine|imprisonment|disgorgement|cease_and_desist|other",
   "description": "", "duration": null, "amount": null}],
 "settlement": null, "court": null, "case_number": null, "release_number": null, "full_text": ""}],
 "extraction_notes": null}

Use only what the digest states, copy names and citations as printed, and put null where it is silent."""


def build_prompt(content: Column, template: str = DEFAULT_TEMPLATE) -> Column:
    """The template with ``{content}`` replaced by the text."""
    before, after = template.split("{content}")
    return F.concat(F.lit(before), content, F.lit(after))
