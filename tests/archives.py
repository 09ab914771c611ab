"""Builders for small archives."""

import io
import tarfile
import zipfile


def zipped(entries: dict) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def tarred(entries: dict) -> bytes:
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as archive:
        for name, content in entries.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return buffer.getvalue()


def ep_xml(number: int, **attributes) -> bytes:
    more = "".join(f' {k}="{v}"' for k, v in attributes.items())
    return f'<d id="EP{number}" doc-number="{number}"{more}><B540><B541>en</B541><B542>T{number}</B542></B540></d>'.encode()
