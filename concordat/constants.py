"""Fixed values.

Everything here has to equal the published data formats and rule tables for
results to agree, so each value is written out plainly in its natural order.
"""

# --- whitespace that a full Unicode strip removes ---------------------------
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- file names --------------------------------------------------------------
LICENCE_FILE_PATTERN = r"(?i)(?:^|/)(LICEN[SC]E|COPYING|NOTICE|COPYRIGHT)([._-]\S*)?$"
ROOT_LICENCE_NAMES = (
    "license", "license.txt", "license.md", "license-mit", "license-apache",
    "license-2.0", "license-2.0.txt",
    "copying", "copying.txt", "copying.md",
    "notice", "notice.txt", "notice.md",
)
SOURCE_EXTENSIONS = (
    "rs", "py", "js", "ts", "svelte", "c", "cc", "cpp", "h", "hpp",
    "go", "java", "rb", "php", "sh",
)
NOISE_MARKS = ("__pycache__", ".dist-info", ".egg-info", "~")
PROBE_NAMES = (
    "LICENSE", "LICENSE.md", "LICENSE.txt", "license", "license.md", "license.txt",
    "COPYING", "COPYING.md", "COPYING.txt", "LICENCE", "LICENCE.md", "LICENCE.txt",
    "NOTICE", "NOTICE.md", "NOTICE.txt",
)

# --- text tests --------------------------------------------------------------
MIN_TEXT_CHARS = 200
TEXT_HEAD_CHARS = 500
MIN_PROBE_BYTES = 50
PROBE_HEAD_BYTES = 1024
HTML_MARKS = ("<html", "<!doctype")
LICENCE_WORDS = ("permission", "license", "copyright", "redistribut", "warranty")
PHRASE_HEAD_CHARS = 2000
FINGERPRINT_HEAD_CHARS = 5000
EVIDENCE_CHARS = 500
HEADER_MAX_FILES = 100
HEADER_MAX_LINES = 50

COPYRIGHT_PATTERN = (
    r"(?:Copyright\s*(?:\([cC]\)|©)?|©|\([cC]\))"
    r"\s+\d{4}(?:[\s,\-]+\d{2,4})*"
    r"\s+[A-Za-z][^\r\n]{2,200}"
)
COPYRIGHT_MAX_CHARS = 250

REDACTED = "[REDACTED-PATH]"
PATH_PATTERNS = (
    r"(?i)[A-Z]:\\[^\s'\"]*",
    r"/home/[^\s'\"]*",
    r"/Users/[^\s'\"]*",
    r"/mnt/[^\s'\"]*",
    r"/root/[^\s'\"]*",
)

# --- SPDX tables -------------------------------------------------------------
SPDX_SYNONYMS = {
    "gpl-3.0": "gpl-3.0-only",
    "gpl-2.0": "gpl-2.0-only",
    "lgpl-2.1": "lgpl-2.1-only",
    "lgpl-3.0": "lgpl-3.0-only",
    "agpl-3.0": "agpl-3.0-only",
}
COMMERCIAL_REF = "LicenseRef-scancode-commercial-license"
INTERNAL_REF = "LicenseRef-scancode-"
APPENDIX_REWRITES = (
    ("GPL-3.0-only AND GPL-3.0-or-later", "GPL-3.0-only"),
    ("GPL-3.0-or-later AND GPL-3.0-only", "GPL-3.0-only"),
    ("GPL-2.0-only AND GPL-2.0-or-later", "GPL-2.0-only"),
)
HUB_LICENCE_IDS = {
    "Apache-2.0": "apache-2.0",
    "MIT": "mit",
    "GPL-3.0": "gpl-3.0",
    "GPL-3.0-only": "gpl-3.0",
    "GPL-3.0-or-later": "gpl-3.0",
    "BSD-3-Clause": "bsd-3-clause",
    "BSD-2-Clause": "bsd-2-clause",
}

FILENAME_HINTS = {
    "MIT": ("mit",),
    "Apache-2.0": ("apache", "apache-2", "apache2"),
    "BSD-3-Clause": ("bsd-3", "bsd3", "bsd"),
    "BSD-2-Clause": ("bsd-2", "bsd2", "bsd"),
    "ISC": ("isc",),
    "GPL-3.0-or-later": ("gpl-3", "gpl3", "gplv3"),
    "GPL-3.0": ("gpl-3", "gpl3", "gplv3"),
    "GPL-2.0-or-later": ("gpl-2", "gpl2", "gplv2"),
    "LGPL-2.1": ("lgpl-2", "lgpl2.1", "lgplv2"),
    "LGPL-3.0": ("lgpl-3", "lgpl3"),
    "MPL-2.0": ("mpl", "mozilla"),
    "Unlicense": ("unlicense",),
    "Zlib": ("zlib",),
    "PSF-2.0": ("psf", "python"),
}
CONTENT_PHRASES = {
    "MIT": "Permission is hereby granted, free of charge",
    "Apache-2.0": "Apache License",
    "BSD-3-Clause": "Redistribution and use in source and binary forms",
    "ISC": "Permission to use, copy, modify",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE",
    "GPL-3.0-or-later": "GNU GENERAL PUBLIC LICENSE",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE",
    "MPL-2.0": "Mozilla Public License",
    "PSF-2.0": "PYTHON SOFTWARE FOUNDATION",
}
# Order matters: results list ids in this order.
FINGERPRINTS = (
    ("Unicode-3.0", "unicode license v3"),
    ("Unicode-3.0", "unicode, inc. license v3"),
    ("Apache-2.0 OR MIT", "rust project is dual-licensed under apache 2.0 and mit"),
    ("GPL-3.0", "gnu general public license\n                       version 3"),
    ("GPL-2.0", "gnu general public license\n                       version 2"),
    ("LGPL-2.1", "gnu lesser general public license\n                       version 2.1"),
    ("Apache-2.0", "apache license\n                           version 2.0"),
    ("MIT", "permission is hereby granted, free of charge"),
    ("BSD-3-Clause", "redistribution and use in source and binary forms"),
    ("ISC", "permission to use, copy, modify, and/or distribute"),
    ("MPL-2.0", "mozilla public license version 2.0"),
    ("PSF-2.0", "python software foundation license"),
)

# --- components and scans ----------------------------------------------------
PURL_PREFIXES = ("pkg:cargo/", "pkg:npm/", "pkg:pypi/", "pkg:generic/")
BUCKET_PREFIX = {
    "npm": "pkg:npm/",
    "nodes": "pkg:generic/",
    "overrides": "pkg:generic/",
    "rust": "pkg:cargo/",
    "python": "pkg:pypi/",
}
SCAN_BUCKETS = ("npm", "nodes", "overrides", "rust", "python")
CAT_RUST = "Rust Crates"
CAT_NPM = "NPM Packages"
CAT_PYTHON = "Python Packages"
CAT_MODELS = "AI Models"
CAT_GIT_HOSTED = ("ComfyUI Nodes", "Embedded Python Overrides")
CAT_SYSTEM = "System Tools"

SCAN_VERDICTS = ("ACK", "MISMATCH", "NO-DETECTION")
AUDIT_VERDICTS = ("ACK", "MISMATCH", "UNKNOWN", "CURATED")
AV_CATEGORIES = (
    "malicious", "suspicious", "undetected", "harmless",
    "timeout", "confirmed-timeout", "failure", "type-unsupported",
)
AV_FLAGGED = ("malicious", "suspicious")

# --- report layout -----------------------------------------------------------
BLOCK_RULE = "═" * 75
NO_LICENCE_TEXT = "(license text not embedded; see homepage)"
RATIONALE_CHARS = 200
