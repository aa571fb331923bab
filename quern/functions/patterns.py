"""Patterns and word lists of the privacy scan."""

#: Patterns of direct identifiers in free text (fixed values; ASCII character classes).
IN_TEXT = {
    "email": r"[\w.+-]+@[\w-]+\.[\w.]+",
    "phone": r"(?:\+?\d[\s.-]?){7,}\d",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "mrn": r"\b(?:MRN|mrn)[\s:#]*\d+\b",
    "date": r"\b(?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4})\b",
    "person_title": r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+[A-Z][a-z]+",
    "url": r"https?://\S+",
}

#: Parts of column names that tell of direct identifiers (fixed values).
IN_NAMES = ("name", "mrn", "medical_record", "dob", "birth", "address", "street", "city", "zip", "postal", "phone", "tel", "email", "ssn", "insurance", "accession", "physician", "doctor")

#: The form of a pseudonym (fixed value).
PSEUDONYM_FORM = r"^PAT-[0-9a-f]{12}$"

#: Ages above this must be grouped (fixed value).
OLDEST_TOLD = 89
