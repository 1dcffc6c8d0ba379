"""Job parameters that differ between publishers of inventories."""

from __future__ import annotations

from dataclasses import dataclass, field

from concordat import constants as C


@dataclass(frozen=True)
class Profile:
    """Names a publisher gives to its own properties, and job-level knobs."""

    category_property: str = "component:category"
    depot_property: str = "component:depot"
    text_property: str = "component:licenseText"
    curation_label: str = "sbom_drift_curation.json"
    notices_title: str = "Third-Party Notices"
    extra_path_patterns: tuple[str, ...] = ()
    header_max_files: int | None = None  # C.HEADER_MAX_FILES gives the published tools' cost cap
    header_max_lines: int = C.HEADER_MAX_LINES
    upstream_order: tuple[str, ...] = ("hub", "git")
    major_vendors: tuple[str, ...] = field(
        default=("BitDefender", "ESET-NOD32", "Kaspersky", "Microsoft", "Sophos", "Symantec")
    )


DEFAULT_PROFILE = Profile()
