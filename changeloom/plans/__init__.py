"""Plans: the models (staging, marts, metrics, history, checks) composed
from operators, plus the pipeline run and the query registry."""
