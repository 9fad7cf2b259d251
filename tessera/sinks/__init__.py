"""Writers of volumes, archives and reports."""
