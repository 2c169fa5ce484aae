"""All registered queries; importing this package fills the registry."""

from workloads.queries import cleaning, features, learning, panel, reports, sources, splits  # noqa: F401
