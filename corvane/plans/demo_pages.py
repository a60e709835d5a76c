"""A plugin package's only module, as a package author would write it; see ``plugin_archive``."""


def processors():
    """Extractors by extension, the contract of an entry point."""
    return {".page": tags, ".broken": refuse}


def tags(path, content):
    """The number of opening brackets of a page, as its text."""
    return str(content.count(b"<")), {"file_size": len(content)}


def refuse(path, content):
    raise ValueError(f"cannot read {path}")
