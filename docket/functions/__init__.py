"""Part of docket."""
