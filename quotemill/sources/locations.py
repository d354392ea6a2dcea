"""Files and folders as tasks open them: by their paths, with Arrow's file systems."""

from __future__ import annotations


def locator():
    """A function for tasks: ``path`` to (file system, path in it, what comes before that in ``path``).

    Nested here, so that executors need nothing but Python and Arrow.
    """

    def located(path):
        import re

        from pyarrow import fs

        scheme, authority, name = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(.*)", path, re.DOTALL).groups()
        before = path[: len(path) - len(name)]
        if scheme in (None, "file"):
            return fs.LocalFileSystem(), name, before
        known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        system, root = fs.FileSystem.from_uri(f"{known}://{authority}/")
        # in an object store, names begin with the bucket
        root = root.rstrip("/")
        return system, root + name, before.removesuffix(root) if root else before

    return located
