"""Fixed values that decide results: addresses, selectors' keywords and labels."""

# Site base that relative links are resolved against, and the search addresses.
SITE = "https://scholar.google.com"
PEOPLE_SEARCH = SITE + "/citations?view_op=search_authors&hl=en&oi=ao&mauthors="
TITLE_SEARCH = SITE + "/scholar?q="

# Keywords of the profile headline, tested as lower-case substrings.
POSITION_WORDS = ("professor", "prof", "director", "head")
INSTITUTION_WORDS = ("institute", "university", "school", "college", "campus")

# Labels of the article page (English and German).
AUTHOR_LABELS = ("Authors", "Autoren", "Inventors")
DATE_LABELS = ("Publication date", "Publikationsdatum")
BOOK_LABELS = ("Book", "Zeitschrift", "Journal", "Source")
PAGES_LABELS = ("Pages", "Seiten")
DESCRIPTION_LABELS = ("Description", "Beschreibung")
TOTAL_LABELS = ("Total citations", "Zitate insgesamt")
TOTAL_PREFIXES = ("Cited by ", "Zitiert von: ")

# Whole class attributes of one search result, and starts of its cited-by link.
RESULT_CLASSES = ("gs_r gs_or gs_scl", "gs_r gs_or gs_scl gs_fmar")
CITED_BY_STARTS = ("Cited by", "被引用次数")

# The characters Python's str.split() and str.strip() treat as white space.
PY_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
