"""Where the stores of a lake are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Folder layout below one root, on any file system that Spark can reach."""

    root: str

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def rejects(self, source: str) -> str:
        return f"{self.root}/rejects/{source}"

    def landed(self, source: str) -> str:
        return f"{self.root}/landed/{source}"

    def landed_rejects(self, source: str) -> str:
        return f"{self.root}/landed_rejects/{source}"

    def landing_progress(self, source: str, part: str) -> str:
        return f"{self.root}/landing_progress/{source}/{part}"

    def silver(self, source: str) -> str:
        return f"{self.root}/silver/{source}"

    @property
    def labels(self) -> str:
        return f"{self.root}/gold/label_store"

    @property
    def features(self) -> str:
        return f"{self.root}/gold/feature_store"

    @property
    def predictions(self) -> str:
        return f"{self.root}/gold/model_predictions"

    @property
    def monitoring(self) -> str:
        return f"{self.root}/gold/model_monitoring"

    @property
    def models(self) -> str:
        return f"{self.root}/model_bank"

    @property
    def registry(self) -> str:
        return f"{self.root}/model_bank/registry"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"
