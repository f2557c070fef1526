"""readloom.streaming"""
