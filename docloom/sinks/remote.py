"""The remote knowledge base and push messages, over HTTP. Both are given as callables, so tests and other services replace them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from docloom.operators.publish import UploadHold

#: How much of a push message and of an error a service takes.
PUSH_LIMIT, ERROR_LIMIT = 1000, 200
TIMEOUT = 120


def call(request: Request, opener: Callable = urlopen) -> tuple[int, str]:
    """(status, body) of any answer, errors among them."""
    try:
        with opener(request, timeout=TIMEOUT) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except HTTPError as error:
        return error.code, error.read().decode("utf-8", "replace")


@dataclass
class KnowledgeBase:
    """Uploads and deletes Markdown documents. Without a key every call holds, as nothing can be published."""

    upload_url: str
    delete_url: str
    key: str | None
    fields: dict[str, str] | None = None
    opener: Callable = urlopen

    def headers(self) -> dict[str, str]:
        if not self.key:
            raise UploadHold("no key for the knowledge base")
        return {"Authorization": f"Bearer {self.key}"}

    def delete(self, file_id: str) -> None:
        """Remove a document; one that is gone already counts as removed."""
        status, body = call(Request(f"{self.delete_url}/{file_id}", headers=self.headers(), method="DELETE"), self.opener)
        if status not in (200, 204, 404):
            raise RuntimeError(f"delete of {file_id}: {status} {body[:ERROR_LIMIT]}")

    def upload(self, name: str, md: str, params: dict, key: str | None = None) -> str:
        """Put a document up and return its id; the service must say that it was created and under which id.

        key travels as Idempotency-Key, by which services know a request that they have answered before.
        """
        edge = uuid.uuid4().hex
        parts = [f'--{edge}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in {**(self.fields or {}), **params}.items()]
        parts.append(f'--{edge}\r\nContent-Disposition: form-data; name="uploaded_files"; filename="{name}"\r\nContent-Type: text/markdown\r\n\r\n'.encode() + md.encode("utf-8") + b"\r\n")
        headers = {**self.headers(), "Content-Type": f"multipart/form-data; boundary={edge}", **({"Idempotency-Key": key} if key else {})}
        status, body = call(Request(self.upload_url, data=b"".join(parts) + f"--{edge}--\r\n".encode(), headers=headers, method="POST"), self.opener)
        if status != 201:
            raise RuntimeError(f"upload of {name}: {status} {body[:ERROR_LIMIT]}")
        found = json.loads(body).get("uploaded_files") or []
        if not found:
            raise RuntimeError(f"upload of {name}: no id in {body[:ERROR_LIMIT]}")
        return found[0]["file_id"]


def push(url: str, fields: dict[str, str], opener: Callable = urlopen) -> Callable[[str, str], bool]:
    """notify(title, text) by a form post, the text cut to what the service takes. A failure is no reason to stop: False."""

    def notify(title: str, text: str) -> bool:
        try:
            return call(Request(url, data=urlencode({**fields, "title": title, "message": text[:PUSH_LIMIT]}).encode()), opener)[0] < 300
        except OSError:
            return False

    return notify
