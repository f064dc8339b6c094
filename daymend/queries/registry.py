"""All registered queries."""

from daymend.queries import models, quality, writes

QUERIES = {**models.QUERIES, **writes.QUERIES, **quality.QUERIES}
