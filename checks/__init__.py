"""Support for checking the package against another engine: mapped input and reference SQL."""
