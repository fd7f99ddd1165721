"""The jobs, composed from the operators: train, predict, respond, monitor."""

from riskloom.plans.monitor import MonitorConfig, monitor
from riskloom.plans.predict import predict, score_table
from riskloom.plans.respond import respond
from riskloom.plans.train import train_job

__all__ = ["MonitorConfig", "monitor", "predict", "respond", "score_table", "train_job"]
